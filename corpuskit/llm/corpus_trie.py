"""Vocabulary tries over a whole corpus, asked for the ends of some of its values.

A trie is kept as a table of hashed nodes with two counts, over every position of every text:

* ``word`` nodes, read forwards from the start of a word (a run of Latin letters, or of Han characters
  between two marks): how many longer words go on below the node, and how many words end at it;
* ``end`` nodes, read backwards from a position (the last 2 ... 16 characters), and ``clause`` nodes (the
  first five, seven or nine characters of the clause and the last two): how often the node occurs, and
  how often a sentence ends there;
* ``piece`` nodes, read forwards from the start of a sentence: how many complete sentences begin so.

The end of a value itself is never counted, as it is what the tries are asked about. Only nodes that
are asked for are counted, which a Bloom filter of bounded size decides in the scan; along the ``end``
nodes a position goes on only while it meets nodes that were asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .common import Sieve
from .kernels import MULT, U64, flat, mix, powers, slices, texts

LENGTHS = (2, 3, 4, 6, 9, 12, 16)
HEADS = (5, 7, 9)  # how much of a clause's beginning its nodes hold
WORD, CLAUSE, PIECE = 101, 102, 103

# Mark-up, full-width forms, marks that end a sentence or a clause.
TAG = re.compile(r"<[^<>]{0,200}>|&(?:[a-z]{2,8}|#\d{1,6});", re.I)
FOLD = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 0x20, 0x00A0: 0x20, ord("．"): 0x2E, ord("｡"): ord("。"), ord("，"): 0x2C}
END = re.compile(r"(?:[。!?]|\.(?=\s|$|[^\d\s.]))+[\"'”’)\]]*")
CUT_MARKS = "…�·—–-_~*#`^\"'“‘([{<，,、;；:：/\\|"
CLOSED = "。!?.！？．｡"
GOES_ON = (",", "、", ";", ":")

@cache
def fold_table() -> np.ndarray:
    """Code point -> lower-cased, half-width code point; any digit is 0, any white space a blank."""
    table = np.arange(0x110000, dtype=np.uint32)
    for lo, hi in ((0, 0xD800), (0xE000, 0x32400)):
        for cp in range(lo, hi):
            c = chr(FOLD.get(cp, cp))
            table[cp] = 32 if c.isspace() else 48 if c.isdecimal() else ord(c.lower()[0])
    return table


class Folded:
    """A batch of folded texts: one array of code points, row starts, and prefix sums for hashing."""

    def __init__(self, column: pa.Array) -> None:
        codes, starts = flat(pc.replace_substring_regex(column, r"(?i)<[^<>]{0,200}>|&(?:[a-z]{2,8}|#[0-9]{1,6});", " "))
        codes = fold_table()[codes]
        again = np.zeros(len(codes), bool)
        again[1:] = (codes[1:] == codes[:-1]) & ((codes[1:] == 48) | (codes[1:] == 32))
        again[starts[:-1][starts[:-1] < len(codes)]] = False
        codes, starts = _kept(codes, starts, ~again)
        edge = np.zeros(len(codes), bool)
        some = np.diff(starts) > 0
        edge[starts[:-1][some]] = edge[starts[1:][some] - 1] = True
        self.codes, self.starts = _kept(codes, starts, ~edge | (codes != 32))
        forth, self.back = powers(len(self.codes) + 1)
        self.sums = np.zeros(len(self.codes) + 1, U64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(self.codes.astype(U64) + U64(0x1F3D5B79)) * forth[: len(self.codes)], out=self.sums[1:])
        self.row = np.repeat(np.arange(len(starts) - 1), np.diff(self.starts))

    def hashes(self, begin: np.ndarray, end: np.ndarray, kind: int, salts: np.ndarray) -> np.ndarray:
        """Node of each stretch of characters in the trie of a kind and group."""
        with np.errstate(over="ignore"):
            h = self.sums[end]
            h -= self.sums[begin]
            h *= self.back[begin]
            h += U64(kind) * MULT + salts
            return mix(h)

    def sentence_ends(self) -> np.ndarray:
        c, n = self.codes, len(self.codes)
        after = np.zeros(n, np.uint32)
        after[:-1] = c[1:]
        after[self.starts[1:][np.diff(self.starts) > 0] - 1] = 32
        mark = (c == ord("。")) | (c == ord("!")) | (c == ord("?")) | (c == ord(".")) & (after != 48) & (after != ord("."))
        first = mark.copy()
        first[1:] &= ~mark[:-1] | (self.row[1:] != self.row[:-1])
        return first

    def clause_starts(self) -> np.ndarray:
        """For each position, where its clause begins."""
        c, n = self.codes, len(self.codes)
        edge = np.isin(c, np.frombuffer(",;:、。!?".encode("utf-32-le"), np.uint32))
        dots = np.nonzero(c[:-1] == ord("."))[0]
        edge[dots[c[dots + 1] != 48]] = True
        begin = np.zeros(n + 1, np.int64)
        begin[1:][edge] = np.nonzero(edge)[0] + 1
        begin[self.starts[:-1]] = self.starts[:-1]
        begin = np.maximum.accumulate(begin)[:n]
        return begin + (c[np.minimum(begin, n - 1)] == 32)

    def clauses(self, begin: np.ndarray, at: np.ndarray, head: int, salts: np.ndarray) -> np.ndarray:
        two = self.hashes(at - 2, at, CLAUSE, salts)
        with np.errstate(over="ignore"):
            return mix(self.hashes(begin, begin + head, CLAUSE, salts) * MULT + two)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all runs of Latin letters and of Han characters."""
        c = self.codes
        kind = ((c >= 97) & (c <= 122)).astype(np.int8) + 2 * ((c >= 0x3400) & (c <= 0x9FFF)).astype(np.int8)
        change = np.ones(len(c) + 1, bool)
        change[1:-1] = (kind[1:] != kind[:-1]) | (self.row[1:] != self.row[:-1])
        at = np.nonzero(change)[0]
        begin, end = at[:-1], at[1:]
        ok = kind[begin] > 0 if len(begin) else np.zeros(0, bool)
        return begin[ok], end[ok]


def _kept(codes: np.ndarray, starts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pos = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(keep, out=pos[1:])
    return codes[keep], pos[starts]


def group_salts(column: pa.Array) -> np.ndarray:
    enc = column.dictionary_encode()
    values = np.array([xxhash.xxh3_64_intdigest(str(v.as_py()).encode()) for v in enc.dictionary] or [0], U64)
    return values[enc.indices.fill_null(0).to_numpy().astype(np.int64)] if len(column) else np.zeros(0, U64)


def tail(text: str) -> tuple[str, str]:
    """(text without what follows its last letter or digit, that rest)."""
    end = len(text)
    while end and not text[end - 1].isalnum() and text[end - 1] not in "%℃°)】」』":
        end -= 1
    return text[:end], text[end:]


def last_piece(folded: str) -> tuple[int, str]:
    """(where the last sentence ends, what follows it); without a sentence end nothing follows."""
    at = 0
    for m in END.finditer(folded):
        at = m.end()
    return at, folded[at:].rstrip(" .。!") if at else ""


def may_be_open(text: str | None) -> bool:
    """False for values that plainly end with a sentence end; others are looked at more closely."""
    text = (text or "").rstrip()
    return bool(text) and (text[-1] not in CLOSED or not (text[-2:-1].isalnum() or text[-2:-1] in "%％)）"))


def is_open(after: str) -> bool:
    rest = after.strip()
    return not (rest and rest[0] in CLOSED and not rest.startswith(("...", "。。")) and not set(after) & set("…�"))


OPEN_SCHEMA = (
    "grp string, id long, uid long, len int, goes_on boolean, nodes array<long>, clauses array<long>, word long, word_len int, han boolean, piece long, piece_len int, before long"
)


def open_values(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Of ``(grp, id, text)``: the values that don't end with a sentence end, and the nodes at their ends."""
    out: dict[str, list] = {c.split()[0]: [] for c in OPEN_SCHEMA.split(", ")}
    raw = batch.column("text").to_pylist()
    pick = [i for i, t in enumerate(raw) if may_be_open(t)]
    if pick:
        f = Folded(batch.column("text").take(pa.array(pick)))
        salts = group_salts(batch.column("grp").take(pa.array(pick)))
        grp, ids = batch.column("grp").to_pylist(), batch.column("id").to_pylist()
        begins = f.clause_starts() if len(f.codes) else None
        for k, (i, text, at) in enumerate(zip(pick, texts(f.codes, f.starts), f.starts[:-1].tolist())):
            body, after = tail(text)
            if not body or not is_open(after):
                continue
            end = at + len(body)
            lengths = np.array([n for n in LENGTHS if n <= len(body)], np.int64)
            salt = salts[k : k + 1]
            nodes = [int(f.hashes(np.array([end - n]), np.array([end]), int(n), salt).view(np.int64)[0]) for n in lengths.tolist()]
            begin = int(begins[end - 1])
            clauses = [int(f.clauses(np.array([begin]), np.array([end]), n, salt).view(np.int64)[0]) for n in HEADS if end - begin >= n + 2]
            m = re.search(r"[a-z]+$|[㐀-鿿]+$", body)
            word = f.hashes(np.array([end - len(m[0])]), np.array([end]), WORD, salt).view(np.int64)[0] if m else None
            cut, piece = last_piece(text)
            lead = len(piece) - len(piece.lstrip())
            piece = piece.strip()
            held = len(piece) >= 3
            node = f.hashes(np.array([at + cut + lead]), np.array([at + cut + lead + len(piece)]), PIECE, salt).view(np.int64)[0] if held else None
            row = (
                grp[i], ids[i], xxhash.xxh3_64_intdigest(f"{grp[i]}\n{ids[i]}\n{raw[i]}".encode("utf-8", "replace")) - (1 << 63),
                len(raw[i].rstrip(CUT_MARKS + " ")), after.strip()[:1] in GOES_ON, nodes, clauses, word, len(m[0]) if m else None, bool(m) and m[0][0] > "z",
                node, len(piece) if held else None, xxhash.xxh3_64_intdigest(text[:cut].encode("utf-8", "replace")) - (1 << 63) if held else None,
            )
            for column, value in zip(out.values(), row):
                column.append(value)
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    return pa.RecordBatch.from_pydict(out, pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in OPEN_SCHEMA.split(", ")]))


def counted(nodes: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """(node, how often, how often with a hit)."""
    order = np.sort(nodes)
    first = np.nonzero(np.r_[True, order[1:] != order[:-1]])[0] if len(order) else np.zeros(0, np.int64)
    values, n = order[first], np.diff(np.append(first, len(order)))
    ended = np.zeros(len(values), np.int64)
    np.add.at(ended, np.searchsorted(values, nodes[hit]), 1)
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(ended)], names=["node", "n", "ended"])


def node_counts(known: Sieve, word_lengths: list[int], piece_lengths: list[int]):
    """``(grp, text)`` -> ``(node, n, ended)`` of the nodes the filter lets pass, per slice of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                f = Folded(batch.column("text"))
                if not len(f.codes):
                    continue
                salts = group_salts(batch.column("grp"))
                alike = len(salts) and (salts == salts[0]).all()
                salted = (lambda at: salts[0]) if alike else (lambda at: salts[f.row[at]])
                offset, ends = np.arange(len(f.codes)) - f.starts[f.row], f.sentence_ends()
                alive, two = np.arange(len(f.codes)), np.zeros(0, np.int64)
                for n in LENGTHS:
                    alive = alive[offset[alive] >= n]
                    h = f.hashes(alive - n, alive, n, salted(alive))
                    met = known.has(h)
                    alive, h = alive[met], h[met]
                    if n == 2:
                        two = alive  # who asks for a clause asks for its last two characters, too
                    if not len(alive):
                        break
                    yield counted(h, ends[alive])
                begin, alive = f.clause_starts(), two
                for n in HEADS:
                    alive = alive[alive - begin[alive] >= n + 2]
                    h = f.clauses(begin[alive], alive, n, salted(alive))
                    met = known.has(h)
                    alive, h = alive[met], h[met]
                    yield counted(h, ends[alive])
                begin, end = f.words()
                size, last = end - begin, f.starts[1:][f.row[begin]]
                for n in word_lengths:
                    at = np.nonzero((size > n) | (size == n) & (end < last))[0]
                    h = f.hashes(begin[at], begin[at] + n, WORD, salted(begin[at]))
                    met = known.has(h)
                    yield counted(h[met], size[at][met] == n)
                if piece_lengths:
                    stop = np.nonzero(ends)[0]
                    start = np.maximum(np.r_[0, stop[:-1] + 1], f.starts[f.row[stop]]) if len(stop) else stop
                    for _ in range(4):  # blanks and closing quotes before a sentence
                        start = start + np.isin(f.codes[np.minimum(start, len(f.codes) - 1)], np.frombuffer(" \"'”’)].。!?".encode("utf-32-le"), np.uint32))
                    for n in piece_lengths:
                        at = np.nonzero(stop - start >= n)[0]
                        h = f.hashes(start[at], start[at] + n, PIECE, salted(start[at]))
                        met = known.has(h)
                        yield counted(h[met], np.ones(int(met.sum()), bool))

    return run
