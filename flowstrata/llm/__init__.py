"""Training-data operators: language, near copies, line quality, personal
data, mixing, sharding, toxicity, token files, URL rules, decontamination.

Nothing else in the library imports this package."""
