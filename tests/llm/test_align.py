import collections
import hashlib
import itertools
import os

import llm_tables as T
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import align as al
from basketry.llm.tokencache import read_tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files():
    return read_tokenizer(al.TOKENIZER_A), al.read_model(al.MODEL_B)


@pytest.fixture(scope="module")
def libraries(files):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(files[0])
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_proto=files[1])
    return a, b


def b_bytes(b, i):
    piece = b.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()


def a_offsets(a, text):
    """Byte ends of A's tokens, from the token strings (one character is one byte)."""
    e = a.encode(" " + text, add_special_tokens=False)
    ends, at = [], 0
    for t in e.tokens:
        at += len(t)
        ends.append(at)
    return e.ids, ends


def plain(a, b, rows):
    """The contract, token by token."""
    docs = []
    for i, text in rows:
        ids_a = ids_b = ends_a = ends_b = []
        if text:
            ids_a, ends_a = a_offsets(a, text)
            ids_b = b.encode(text)
            spelled = [b_bytes(b, x) for x in ids_b]
            ends_b = list(itertools.accumulate(map(len, spelled)))
            if b"".join(spelled) != (" " + text).encode() or ends_a[-1] != len((" " + text).encode()):
                ids_a = ids_b = ends_a = ends_b = []
        docs.append((i, ids_a, ends_a, ids_b, ends_b))
    links, out = [], []
    for _, ids_a, ends_a, ids_b, ends_b in docs:
        of_b = dict(zip(ends_b, ids_b))
        links.append([(x, of_b[e]) for x, e in zip(ids_a, ends_a) if e in of_b])
    count = collections.Counter(x for some in links for x in some)
    best = collections.defaultdict(int)
    for (_, y), c in count.items():
        best[y] = max(best[y], c)
    for (i, ids_a, ends_a, ids_b, ends_b), some in zip(docs, links):
        groups, x, y = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            p, q = [], []
            while x < len(ids_a) and ends_a[x] <= e:
                p.append(str(ids_a[x]))
                x += 1
            while y < len(ids_b) and ends_b[y] <= e:
                q.append(str(ids_b[y]))
                y += 1
            groups.append(",".join(p) + "|" + ",".join(q))
        text = ";".join(groups)
        out.append((
            i, len(ids_a), len(ids_b), len(groups), len(some), sum(count[s] == best[s[1]] for s in some),
            sum(count[s] for s in some), hashlib.sha256(text.encode()).hexdigest() if ids_a else "",
        ))
    return sorted(out, key=str)


ODD = [
    "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ not a space", "a\nb\tc   d e", " lead", "trail ",
    "zero\x00byte", "😀é́ 中 文", "a b", "word_word 1 2", "\u0085x", "ﬁ ＡＢＣ ½", " ", "\n",
]


def test_against_plain_version(spark, files, libraries):
    docs = T.documents(spark).unionByName(
        T.plain(spark, ODD, [100 + i for i in range(len(ODD))]), allowMissingColumns=True
    )
    got = al.align(docs, *files).collect()
    want = plain(*libraries, [(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got), key=str) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[101].n_a == 0 and by_id[101].groups_sha256 == ""  # a written U+2581
    assert by_id[100].n_links > 0


def test_parts_and_chunks_give_the_same(spark, files, libraries, monkeypatch):
    for name, value in {"BLOCK_BYTES": 300, "BLOCK_UNITS": 7, "BATCH_CHARS": 20, "REMEMBERED": 9,
                        "CHUNK_PAIRS": 20}.items():
        monkeypatch.setattr(al, name, value)
    texts = [T.SENTENCE * 3, ODD[0] + " " + T.SENTENCE * 5, ODD[1] + " " + T.SENTENCE * 5, None, *ODD,
             "x" * 500 + " y z", "it's  two  spaces and 12 34 " * 20, T.SENTENCE * 3]
    docs = T.plain(spark, texts).repartition(3)
    packed = al.chunks(docs, *files, "doc_id", "text")
    assert packed.count() > 3  # more than tasks
    got = al.align(docs, *files).collect()
    assert sorted(map(tuple, got), key=str) == plain(*libraries, list(enumerate(texts)))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sl1,.<|é́中 \t\n\u00a0\u0085\x1c\u200b😀", max_size=30))
def test_cuts_are_where_both_start_a_token(libraries, text):
    some = al.CUT.split(text)
    assert " ".join(some) == text
    a, b = libraries
    whole = a.encode(" " + text, add_special_tokens=False).ids
    assert sum((a.encode(" " + p, add_special_tokens=False).ids for p in some), []) == whole
    assert sum((b.encode(p) for p in some), []) == b.encode(text) or not text


def test_byte_alphabet_is_the_library_s(files):
    from tokenizers.pre_tokenizers import ByteLevel

    assert set(al.byte_level_alphabet()) == set(ByteLevel.alphabet())
    side = al.ByteLevel(files[0])
    for text in (" ", "\x00", "é", "\n", "­", "😀"):
        ids = side.tokenizer.encode(text, add_special_tokens=False).ids
        assert b"".join(side.bytes[i].as_py() for i in ids) == text.encode()


def test_empty_table_and_null_ids(spark, files, libraries):
    assert al.align(T.empty(spark), *files).collect() == []
    got = al.align(T.plain(spark, ["a b", "a b", None], [None] * 3), *files).collect()
    assert sorted(map(tuple, got), key=str) == plain(*libraries, [(None, "a b"), (None, "a b"), (None, None)])


def test_query_against_plain_version(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = al.op13_alignment(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == plain(*libraries, [(d.doc_id, d.text) for d in docs])
