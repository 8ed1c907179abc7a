"""Rows with nulls, empty and long texts, ties and repetitions, shared by the tests."""

#: Names that the operators use inside or return.
EXTRA = ("score kept rep band a b h w n path dir line said term label x sig shard slot piece length "
         "sequence_id offset held_id gone_id again_id lang_pred component_id record_type refers_to").split()

LONG = " ".join(f"word{i % 977} {i}" for i in range(60_000))
PASSAGE = " ".join(f"alpha{i} beta{i}" for i in range(40))

ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "s", 10),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "s", 10),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "s", 10),
    (3, PASSAGE, "de", None, 5), (4, PASSAGE + " end", None, "s", None), (4, "something else here", "en", "t", 1),
    (5, None, "en", "s", 0), (6, "", "fr", "s", 0), (7, " \t\n ", "fr", "s", 4), (8, "one two", "es", "s", 7),
    (9, "ONE two", "es", "s", 7), (None, PASSAGE, "de", "s", 3), (None, None, None, None, None),
    (10, LONG, "en", "s", len(LONG)), (11, "12345 67890 !!! ???", "en", "s", 9), (-12, "négatif é à ü", "fr", "s", 9),
]
