"""Documents with nulls in any column, empty, long, repeated and tied texts,
and columns whose names clash with the operators' own."""

LONG = " ".join(f"word{k % 700} of the" for k in range(30_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the moon tonight", "en", "src0", 1), (2, "The cat sat on the mat and looked at the moon tonight", "en", "src0", 1),
    (3, None, "en", "src1", 0), (4, "", None, "src1", 0), (5, " \n\t ", "fr", None, 0), (6, LONG, "en", "src0", None),
    (7, "same same same same", "fr", "src1", 3), (7, "same same same same", "fr", "src1", 3), (None, "un texte sans numéro", "fr", "src2", 4),
    (None, None, None, None, None), (8, "one", "en", "src2", 5), (9, "ONE", "en", "src2", 5), (10, "12 345 ###\n!!\n!!\n\n!!", "de", "src2", 6),
    (11, "der die das und nicht mit der die das und nicht mit", "de", "src3", 7),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, words int, size int, score string, "
          "component int, `class` string, label int")


def documents(spark):
    return spark.createDataFrame([(*r, "x", 1, 2, "s", 3, "c", 4) for r in ROWS], SCHEMA)


def ids(rows):
    return sorted((r.doc_id for r in rows), key=lambda i: -1 if i is None else i)
