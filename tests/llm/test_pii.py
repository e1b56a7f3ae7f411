import re

import llm_tables as T
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_base(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+- 9.2é(b0\n", max_size=80))
def test_base_spans_are_the_patterns_matches(text):
    assert pii.base_spans(text) == plain_base(text)


def test_luhn_and_long_digits():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    assert pii.base_spans("1" * 6000 + ".1.1.1") == []


def test_em_separates_and_classifier_accepts():
    counts = {}
    for votes, n in (((1, 1, 1), 500), ((-1, -1, -1), 800), ((1, -1, 1), 40), ((-1, 1, -1), 30)):
        counts[(4, *votes, 5, 2, 1)] = n
    soft = pii.posteriors({k[1:4]: n for k, n in counts.items()})
    assert soft[(1, 1, 1)] > 0.95 and soft[(-1, -1, -1)] < 0.05
    accepted = pii.fit(counts)
    assert (4, 1, 1, 1, 5, 2, 1) in accepted and (4, -1, -1, -1, 5, 2, 1) not in accepted


def test_spans_on_whole_texts(spark):
    texts = ["x " * 50_000 + "a@b.co", 'k token = "0a1b2c3d4e5f60718293a4b5c6d7" z', None, ""]
    docs = T.plain(spark, texts * 4, list(range(16)))
    got = {r.doc_id: r for r in pii.detect(docs, pii.train(docs)).collect()}
    assert got[0].spans == "email:100000:100006" and got[0].n_email == 1
    assert got[1].spans == "secret:11:39" and got[1].n_added == 1
    assert got[2].base_sha256 == got[3].base_sha256 and got[2].spans == ""


def test_redact_and_awkward_rows(spark):
    docs = T.documents(spark)
    accepted = pii.train(docs)
    assert pii.detect(docs, accepted).count() == docs.count()
    clean = pii.redact(docs, accepted)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[11] == "mail me at <EMAIL> or call <PHONE> from <IP> \x00 ok"
    assert texts[3] is None and texts[4] == "" and texts[9] == T.LONG
    assert pii.detect(T.empty(spark), pii.train(T.empty(spark))).count() == 0
