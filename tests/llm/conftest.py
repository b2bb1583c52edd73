import pytest

ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (3, "one"), (3, "another text of the same id"), (None, "no id, but all rights reserved here"),
    (4, "Ünïcode ÉTÉ ß \U0001F600 and 12 CC BY numbers ９ ²"), (5, "long " * 30_000), (6, "... !!! ---"), (7, "one"), (8, "a\x00b \x1f c\u00a0d\u2003e"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null and empty texts, repeated rows and ids, no id, a long text, and columns named as those that operators add."""
    names = ["score", "host", "path", "rule", "key", "rest", "spans", "kept", "code", "part", "a.b", "tick`s", "_row", "__key", "__hash", "_best", "_hosts", "row", "there", "hash"]
    rows = [(k, t, None, *("x" for _ in names)) for k, t in ODD]
    kinds = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, {kinds}")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def sample(spark):
    """Documents at the smallest scale, as a frame and as (doc_id, text, lang)."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, [(r.doc_id, r.text, r.lang) for r in df.orderBy("doc_id").collect()]
