"""Documents with the awkward cases, and a plain corpus."""

import random

WORDS = ("river stone lamp garden winter paper silver window music ocean bread forest candle mirror bridge "
         "copper engine velvet harbor ladder meadow needle orange pencil quiver ribbon saddle timber walnut").split()

# doc_id, text, lang, source, n_chars and columns whose names operators use themselves.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, rid bigint, tail double, "
          "copy int, times int, text_sha256 string, size bigint, target double, slot int, shard int, grp string, "
          "label int, bucket bigint, tid bigint, comp bigint, key string, pass int, id int, name string")
EXTRA = (7, 0.5, 1, 2, "x", 3, 1.0, 4, 5, "g", 1, 6, 7, 8, "k", 9, 10, "n")


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "ing", "ed", "s", str(rng.randrange(50))]) for _ in range(n))


def rows():
    long = sentence(1, 60_000)
    texts = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", None, None), (None, None, None, None),
        (None, "no id here", "en", "b"), (4, long, "en", "b"), (5, long + " more", "de", "b"),
        (6, sentence(2, 40), "en", "a"), (6, sentence(2, 40), "en", "a"), (6, sentence(2, 40), "en", "a"),
        (7, sentence(2, 40), "fr", None), (8, sentence(3, 3), "fr", "c"), (9, "12345 !!! ###", "fr", ""),
        (10, "éè \U0001f600 中文 naïve", "fr", "c"), (6, "other text same id", "en", "a"),
        (11, "a" * 50_000, "en", "a"), (12, 'token = "24be64439e3e49cf46b2d7c90f3602a3"', "en", "a"),
    ]
    return [(*t, len(t[1] or ""), *EXTRA) for t in texts]


def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(spark, texts, **columns):
    data = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def labels(spark, rows_=((6, 1, 0), (8, 0, 1), (9, 0, 0), (10, 1, 1), (None, 1, 0), (6, None, None))):
    return spark.createDataFrame(list(rows_), "doc_id bigint, quality int, toxic int")


def items(spark, texts=("the quick brown fox jumps over the lazy dog near the old river bank today", None, "", "ab c")):
    return spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
