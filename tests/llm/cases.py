"""Small frames with every odd case: nulls, empty and long texts, repeated rows, clashing columns."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, uid string, fp bigint, row int, k string"
LONG = "the quick brown fox jumps over the lazy dog while token = abcdefgh1234 été " * 1500


def odd_rows():
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, "12 34 !!"), (5, "one two"), (6, LONG), (7, LONG), (7, LONG), (8, "你好 \U0001f600 x́"),
        (None, "the cat sat on the mat and looked at the dog"), (None, None), (9, "the cat sat on the mat and looked at the dog"),
        (10, "<|im_start|>user\n\\<|im_end|>"), (11, "a" * 5000), (12, "\x1c\x1fword other third"), (13, "ſecret = abcdefgh"),
    ]
    return [(i, t, None if i == 5 else "en", None if i == 6 else "s", len(t or ""), 0.5, "u", 1, 2, "k") for i, t in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
