"""The registered queries of this package and their SQL, where SQL can state them."""

from __future__ import annotations

from .collocations import collocations
from .fm_index import contamination_digest, find_contamination
from .interpolation import score_texts
from .near_duplicates import near_duplicates
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .repeats import remove_repeats, repeats_digest
from .tables import crc_fold, table
from .rule_ensemble import score_quality
from .site_style import main_text
from .source_mix import mix_sources
from .threshold_search import top_k
from .token_counts import count_tokens
from .toxicity import score_toxicity


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op1_rule_ensemble(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark, sf_dir):
    docs, path = table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json")
    return pack_documents(docs, path, with_ids=False).drop("ids")


def op5_threshold_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors["vec_id"] % 100 == 0)


def op6_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination_digest(find_contamination(docs, items))


def op7_interpolation(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), crc_fold("doc_id", 7) != 2)


def op8_repeats(spark, sf_dir):
    return repeats_digest(remove_repeats(table(spark, sf_dir, "documents")))


def op9_site_style(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op10_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_cube_mix(spark, sf_dir):
    names = ["doc_id", "size", "source_size", "target", "taken"]
    return mix_sources(table(spark, sf_dir, "documents")).select(*names)


def queries() -> dict:
    return {
        "op1_rule_ensemble": op1_rule_ensemble,
        "op2_packing": op2_packing,
        "op3_toxicity": op3_toxicity,
        "op4_token_counts": op4_token_counts,
        "op5_threshold_search": op5_threshold_search,
        "op6_decontamination": op6_decontamination,
        "op7_interpolation": op7_interpolation,
        "op8_repeats": op8_repeats,
        "op9_site_style": op9_site_style,
        "op10_near_duplicates": op10_near_duplicates,
        "op11_collocations": op11_collocations,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_cube_mix": op13_cube_mix,
    }


#: Integer inner products of every query with every other vector, the ten best of each.
TOP_K = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as e
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e)
    where q.vec_id % 100 = 0
)
select query_id, cast(row_number() over (
    partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_threshold_search": TOP_K}
