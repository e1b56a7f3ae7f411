"""Small document tables with the awkward cases every operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 97} the thing" for i in range(12_000))
SENTENCE = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood again "

TEXTS = [
    SENTENCE * 3,
    SENTENCE * 3,  # a copy
    (SENTENCE * 3).replace("lazy", "old", 1),
    None,
    "",
    "   \n\t ",
    "a",
    "12 34 !!",
    "Der schnelle braune Fuchs springt über den faulen Hund und läuft in den tiefen Wald",
    LONG,
    LONG + " and an end",
    "mail me at jane.doe@example.com or call +1 (212) 555-0100 from 10.0.0.1 \x00 ok",
    "▁visible  spaces ",
    "中文 문장 emoji 😀 text",
    "x" * 5000,
]


def rows() -> list[tuple]:
    out = [
        (i, t, ("de" if t and t.startswith("Der") else "en") if i % 5 else None,
         f"s{i % 3}" if i % 4 else None, len(t) if t and i % 2 else None)
        for i, t in enumerate(TEXTS)
    ]
    return [*out, out[0], out[9]]  # repeated rows


def documents(spark: SparkSession) -> DataFrame:
    """The awkward table, with extra columns whose names operators use inside."""
    df = spark.createDataFrame(rows(), SCHEMA)
    extra = {"t": "t", "i": "i", "l": "l", "__spot": "p", "hits": "h", "h": "x", "bucket": "b", "n": "n"}
    for name, value in extra.items():
        df = df.selectExpr("*", f"'{value}' AS `{name}`")
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def plain(spark: SparkSession, texts: list, ids: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")


def shingles(text: str | None, n: int = 5) -> frozenset:
    """Word shingles by the plain definition."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def near_components(ids: list, texts: list, percent: int = 75) -> dict:
    """Smallest reachable id of every document, by comparing all pairs."""
    sets = [shingles(t) for t in texts]
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = top(ids[a]), top(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}
