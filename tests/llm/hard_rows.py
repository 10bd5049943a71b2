"""Rows that each operator has to give a defined result for."""

SF = "/root/testdata/sf0.001"
WORDS = r"[^\x20\x09-\x0D]+"

LONG = " ".join(f"w{i % 997} x{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))

#: (doc_id, text, lang, source): nulls, empties, ties, copies, near copies, a long text, a shared passage.
ROWS = [
    (10, "", "en", "a"), (11, None, "en", None), (12, "one", "en", "b"), (13, "\t \n", None, "b"),
    (14, LONG, "de", "a"), (15, LONG, "de", "c"), (16, LONG + " tail", "de", "a"),
    (17, "Intro words here " + PASSAGE + " outro", "en", "a"), (18, "Other start " + PASSAGE, "en", "c"),
    (19, PASSAGE + " " + PASSAGE, "en", "b"), (20, "a b\nc d\n\nc d\n# $ %\nc d", "en", "a"),
    (21, "ünï ćode ßtraße " * 40, "de", None), (22, "ünï ćode ßtraße " * 40, "de", "a"),
    (23, " ".join(f"plain{i}" for i in range(200)), "en", "b"), (23, " ".join(f"plain{i}" for i in range(200)), "en", "b"),
    (None, "no id " * 30, "en", "a"), (25, "A B 　c <|endoftext|> don't", "en", "a"), (26, "ÄÖ " + "THE END OF IT " * 30, "en", "z"),
]
