"""Piece lattices of many strings at once, by suffix-array matching.

The strings are concatenated (a separator between them), their suffixes are sorted to
the depth of the longest piece, and every piece of the vocabulary is binary-searched for
its range of occurrences. The resulting edges (start, length, piece), sorted by
position, are the lattices of all strings.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # the visible space of piece vocabularies


@dataclass
class Vocabulary:
    """A piece vocabulary, small enough to travel with every task."""

    pieces: list[str]
    scores: np.ndarray
    usable: np.ndarray  # ordinary pieces: not control, unknown or byte pieces
    byte_ids: np.ndarray | None  # id of each byte's piece, None without byte fallback
    unknown: int
    bpe: bool
    dummy_prefix: bool

    @property
    def longest(self) -> int:
        return max((len(p) for p, u in zip(self.pieces, self.usable, strict=True) if u), default=1)


def load_vocabulary(path: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a piece model file (driver only)."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as model_format

    with open(path, "rb") as f:
        raw = f.read()
    model = model_format.ModelProto()
    model.ParseFromString(raw)
    norm = model.normalizer_spec
    if norm.name != "identity" or norm.remove_extra_whitespaces:
        raise ValueError("only vocabularies over unchanged text are supported")
    sp = SentencePieceProcessor(model_proto=raw)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("pieces must not run over a space inside")
    special = [
        sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)
    ]
    byte_ids = None
    if model.trainer_spec.byte_fallback:
        byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    return Vocabulary(
        pieces,
        np.array([sp.get_score(i) for i in range(n)]),
        ~np.array(special),
        byte_ids,
        sp.unk_id(),
        model.trainer_spec.model_type == 2,
        norm.add_dummy_prefix,
    )


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Matcher:
    """Finds every piece in concatenated strings."""

    def __init__(self, vocabulary: Vocabulary):
        self.ids = np.flatnonzero(vocabulary.usable)
        self.longest = vocabulary.longest
        self.sizes = np.array([len(vocabulary.pieces[i]) for i in self.ids])
        self.codes = np.zeros((len(self.ids), self.longest), np.int64)
        for row, i in enumerate(self.ids):
            self.codes[row, : self.sizes[row]] = code_points(vocabulary.pieces[i])

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece id) of all occurrences.

        ``text``: code points, 0 between strings.
        """
        n = len(text)
        alphabet = np.unique(text)
        alphabet = alphabet[alphabet > 0]
        bits = 8 if len(alphabet) < 255 else 16 if len(alphabet) < 65535 else 32
        per = 64 // bits
        top = int(alphabet[-1]) + 2 if len(alphabet) else 2
        rank = np.zeros(top, np.uint64)
        rank[alphabet] = np.arange(1, len(alphabet) + 1)
        codes = np.minimum(self.codes, top - 1)
        known = ((rank[codes] > 0) | (self.codes == 0)).all(1)
        ids, sizes, ranks = self.ids[known], self.sizes[known], rank[codes[known]]
        depth = -(-self.longest // per)
        # packed words of the next ``per`` characters, for each suffix
        word = np.concatenate([rank[text], np.zeros(self.longest + per, np.uint64)])
        width = 1
        while width < per:
            word[:-width] = (word[:-width] << np.uint64(bits * width)) | word[width:]
            width *= 2
        keys = [word[j * per : j * per + n] for j in range(depth)]
        suffixes = _sorted_suffixes(keys)
        lo, hi = np.zeros(len(ids), np.int64), np.full(len(ids), n, np.int64)
        for j, key in enumerate(keys):
            column = key[suffixes]
            low = np.zeros(len(ids), np.uint64)
            high = np.zeros(len(ids), np.uint64)
            for t in range(per):
                at = j * per + t
                r = ranks[:, at] if at < self.longest else np.zeros(len(ids), np.uint64)
                inside = at < sizes
                low = (low << np.uint64(bits)) | np.where(inside, r, np.uint64(0))
                high = (high << np.uint64(bits)) | np.where(inside, r, np.uint64((1 << bits) - 1))
            live = (sizes > j * per) & (hi > lo)
            if j == 0:
                lo = np.searchsorted(column, low, "left")
                hi = np.searchsorted(column, high, "right")
            elif live.any():
                lo[live], hi[live] = (
                    _search(column, lo[live], hi[live], low[live], False),
                    _search(column, lo[live], hi[live], high[live], True),
                )
        many = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(ids)), many)
        first = np.cumsum(many) - many
        start = suffixes[np.arange(int(many.sum())) + (lo - first)[piece]]
        return start, sizes[piece], ids[piece]

    def sorted_edges(self, text: np.ndarray) -> np.ndarray:
        """The lattice sorted by position: at [start, length] the piece id, or -1.

        Each edge is put in its place directly (a counting sort by start and length)."""
        start, size, piece = self.edges(text)
        span = self.longest + 1
        table = np.full((len(text) + 1) * span, -1, np.int32)
        table[start * span + size] = piece
        return table.reshape(-1, span)


def _sorted_suffixes(keys: list[np.ndarray]) -> np.ndarray:
    """Suffix order by the packed words: by the first, then ties by the others."""
    order = np.argsort(keys[0])
    first = keys[0][order]
    tie = np.zeros(len(order) + 1, bool)
    tie[1:-1] = first[1:] == first[:-1]
    among = np.flatnonzero(tie[:-1] | tie[1:])
    group = np.cumsum(~tie[:-1])[among]
    rows = order[among]
    order[among] = rows[np.lexsort([*(k[rows] for k in keys[:0:-1]), group])]
    return order


def _search(
    column: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: np.ndarray, right: bool
) -> np.ndarray:
    """Binary search of each key inside its own sorted range of ``column``."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        value = column[np.minimum(mid, len(column) - 1)]
        less = (value <= key if right else value < key) & open_
        lo = np.where(less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    return lo
