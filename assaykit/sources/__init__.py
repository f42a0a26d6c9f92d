"""Where the data comes from: directories, the dictionary, cohort keys, tables."""
