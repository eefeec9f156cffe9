import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside; a table may have columns of these names too.
CLASHING = ("size", "shard", "key", "lines", "lost", "rep", "component", "kept", "place", "score", "tokens", "grp", "bucket", "start", "target", "id", "item_id", "best", "block", "record")


def documents(spark, texts, extra=False):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in texts]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.select("*", *[F.lit(f"x-{n}").alias(n) for n in CLASHING]) if extra else docs


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def edges_of(texts):
    """Rows beside the ordinary ones: null and empty texts, white space, no id, a repeated row."""
    return [*texts, (900, None), (901, ""), (902, " \t\n\x0b"), (None, texts[0][1]), texts[1], (903, texts[2][1])]
