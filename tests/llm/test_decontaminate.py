import random

import llm_tables as T

from basketry.llm import decontaminate as dc

ITEM = "Which of the following rivers flows through the largest number of countries in Europe today?"


def edit_search(pattern, text):
    """Fewest edits between the pattern and any stretch of the text, by the full table."""
    prev = list(range(len(pattern) + 1))
    best = prev[-1]
    for c in text:
        cur = [0]
        for i, x in enumerate(pattern):
            cur.append(min(prev[i] + (x != c), prev[i + 1] + 1, cur[i] + 1))
        best, prev = min(best, cur[-1]), cur
    return best


def test_bit_parallel_distance():
    rnd = random.Random(1)
    for _ in range(200):
        p = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 90)))
        t = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 150)))
        assert dc.best_distance(dc.letter_masks(p), len(p), t) == edit_search(p, t)


def test_hits_equal_full_search():
    rnd = random.Random(2)
    words = ["the", "river", "of", "europe", "flow", "a", "zinc", "nine"]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 14)))) for i in range(25)]
    matcher = dc.Matcher(items)
    for _ in range(60):
        base = " ".join(rnd.choice(words) for _ in range(30))
        stretch = list(rnd.choice(items)[1])
        for _ in range(rnd.randint(0, 4)):
            stretch[rnd.randrange(len(stretch))] = rnd.choice("xyz ")
        text = base + " " + "".join(stretch) + " " + base
        norm = f" {dc.normalise(text)} "
        want = []
        for i, t in items:
            p = dc.normalise(t)
            d = edit_search(f" {p} " if len(p) < dc.SHORT else p, norm)
            if d <= dc.budget(p if len(p) >= dc.SHORT else f" {p} "):
                want.append((i, d))
        assert [i for i, _ in matcher.hits(text)] == [i for i, _ in sorted(want)]


def test_planted_edited_and_noisy(spark, monkeypatch):
    edited = ITEM.replace("flows", "flowz").replace("Europe", "Europa")
    noisy = "***".join(ITEM.upper().split(" "))
    texts = ["x " + ITEM + " y", edited, noisy, ITEM[:60], None, "", ITEM * 2]
    items = spark.createDataFrame(
        [(7, ITEM), (8, None), (9, ""), (10, ITEM), (11, "zz")], "item_id long, text string"
    )
    want = [[7, 10], [7, 10], [7, 10], [], [], [], [7, 10]]

    def found():
        rows = dc.mark(T.plain(spark, texts), items).collect()
        return [[h.item_id for h in r.hits] for r in sorted(rows, key=lambda r: r.doc_id)]

    assert found() == want
    monkeypatch.setattr(dc, "ITEM_BLOCK_BYTES", 60)  # many blocks, one pass each
    assert found() == want


def test_awkward_rows(spark):
    docs = T.documents(spark)
    items = spark.createDataFrame([(1, T.SENTENCE)], "item_id long, text string")
    kept = dc.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(3, 15))
    nothing = items.limit(0)
    assert dc.drop_contaminated(docs, nothing).count() == docs.count()
    assert dc.drop_contaminated(T.empty(spark), items).count() == 0


def test_items_just_under_short_are_exact_whole_words():
    for item in ("abcd efgh ijkl mno", "abcd efgh ijkl mnop"):  # 18 and 19 characters
        matcher = dc.Matcher([(1, item)])
        assert dc.pieces(f" {item} ") == [(0, f" {item} ")]
        assert matcher.hits(f"so {item}, yes") == [(1, 0)]
        for other in (f"so x{item} yes", f"so {item}x yes", f"so {item.replace('f', 'z')} yes"):
            assert matcher.hits(other) == []
