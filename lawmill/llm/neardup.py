"""Records that share most of their content: pairs alike by at least a threshold.

Likeness is the Jaccard coefficient of the sets of word runs (three words by default) of the
lower-cased text. Method: an exact pigeonhole join over slots, with parity sketches.

1. The hash of a token (a word run) puts it into one of the slots of the set's size band. If two sets are alike by t,
   their parts in at least one slot are alike by t too: were every slot's shared tokens fewer than t times its
   joint ones, so would be their sums. Each slot of a record is joined on its own. Sets meet in the band of the smaller
   one: a set that can have partners in the band below is dealt to its slots as well.
2. All tokens stand in one order: the most frequent ones last, by their counts, the others by hash. Two parts of a
   and b tokens alike by t share at least t/(1+t)*(a+b). From the first token they share on, both must
   hold so many, so it stands in both prefixes of (1-t)*n+1 tokens: records that share a word of a slot's
   prefix, at places that leave enough, are candidates. This is a proof for any order, which
   only keeps the groups small; no token is left out.
3. The XOR of parity bits has a Hamming distance of at most the symmetric difference. Candidates whose
   bits differ in more than (1-t)/(1+t)*(a+b) are dropped, which loses nothing: by the bits of the slot at once, by those of the
   whole records when the pairs of all slots are gathered.
4. The rest are verified by the exact coefficient of their whole texts.

Words are dealt to buckets of bounded size by slot and hash. What a word carries (its record's code, the size and the
few parity bits of one slot) doesn't grow with the number of buckets; a bucket's candidates are made
and tested a chunk at a time.

Records with equal sets are one class, whose smallest key stands for it in the join, so
that copies, even a third of all rows, meet once. A code names a class by some bits of its hash; classes
that share a code are told apart when codes are turned into keys, and compared with each other too. Pairs of a class
and between classes are expanded to their members up to ``EXPANDED`` members; a larger class is given as pairs of its
representative with each member, and its links as links of the representative.

Defined results: null texts, records without a key or of no listed source, and texts below the least number of words have no pairs; ties
at the threshold count as alike; repeated rows of one key are one record.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawmill.session import stage

RUN, THRESHOLD, LEAST_WORDS = 3, 0.6, 20
#: Size bands: the least size of each, and how many first bits of a token's hash name its slot.
BANDS = ((0, 0), (32, 2), (128, 4), (512, 6))
_FLOORS = np.array([b for b, _ in BANDS])
_SLOT_BITS = np.array([k for _, k in BANDS])
_FIRST = np.cumsum(1 << _SLOT_BITS) - (1 << _SLOT_BITS)
SLOTS = int((1 << _SLOT_BITS).sum())
#: A token on more than this share of a partition's records is counted, and the most frequent ones found stand last in the order.
COMMON_SHARE, COMMON_LEAST, COMMON_TOKENS = 0.0005, 10, 1_000_000
#: Words of a bucket on average, words and records packed at once, candidates tested at once.
BUCKET, PACKED, PACKED_RECORDS, TESTED = 1_500_000, 1_000_000, 60_000, 500_000
#: Records up to which 32 bits name a class; beyond, 64.
NARROW_CODES = 1 << 26
#: Members up to which a class of equal sets is expanded into pairs.
EXPANDED = 50
SLICE_CHARS = 600_000

_SPACE = np.array([chr(i).isspace() for i in range(0x3001)] + [False])
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x = x ^ (x >> np.uint64(27))
    x = x * _B
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        a = np.full(max(n, SLICE_CHARS) + 1, base, dtype=np.uint64)
        a[0] = 1
        _powers[key] = np.multiply.accumulate(a)
    return _powers[key][:n]


def token_sets(texts: list[str], run: int = RUN, least: int = LEAST_WORDS) -> list[np.ndarray | None]:
    """The sorted distinct hashes of each text's word runs; None below ``least`` words.

    All texts of a slice are hashed at once: a word's hash is the difference of two prefix sums of
    a polynomial over its code points.
    """
    low = [t.lower() for t in texts]
    cp = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out: list[np.ndarray | None] = [None] * len(texts)
    if not len(cp):
        return out
    word = ~_SPACE[np.minimum(cp, 0x3001)]
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * _power(_R, len(cp)))))
    h = mix((prefix[end] - prefix[start]) * _power(_R_INVERSE, len(cp) + 1)[start])
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in low])))
    bounds = np.searchsorted(start, begins)
    weights = [np.uint64(pow(int(_C), i + 1, 1 << 64)) for i in range(run)]
    runs = sum((h[i : len(h) - run + 1 + i] * w for i, w in enumerate(weights)), np.zeros(1, dtype=np.uint64)) if len(h) >= run else np.zeros(0, dtype=np.uint64)
    runs = mix(runs)
    for k in range(len(texts)):
        a, b = int(bounds[k]), int(bounds[k + 1])
        if b - a >= max(least, run):
            s = np.sort(runs[a : b - run + 1])
            out[k] = s[np.concatenate(([True], s[1:] != s[:-1]))]
    return out


def bound(a, b, t: float = THRESHOLD):
    """The most tokens in which sets of a and b tokens differ at likeness t."""
    return (1 - t) / (1 + t) * (a + b)


def prefix_length(n, t: float = THRESHOLD):
    """How many of the first tokens of a set of n hold the first one shared with any set alike by t."""
    return np.minimum(n, np.floor((1 - t) * n + 1e-6).astype(np.int64) + 1)


#: Whole sizes are compared in steps of this ratio, so that they fit a byte.
SIZE_STEP = 1.05


def size_level(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log(np.maximum(n, 1)) / math.log(SIZE_STEP)), 255).astype(np.int64)


def level(n: np.ndarray, bits: float = 3) -> np.ndarray:
    """Bits of the parity sketch of a set of n, ``bits`` for each token or more."""
    return np.maximum(32, 1 << np.ceil(np.log2(bits * n)).astype(np.int64))


def parity(flat: np.ndarray, part: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parity bits of parts of m bits each, 32 to a number, and where each part's begin."""
    begin = np.cumsum(m) - m
    odd = np.bincount(begin[part] + (flat & (m[part] - 1).astype(np.uint64)).astype(np.int64), minlength=int(m.sum())) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint32), begin // 32


def fold(bits: np.ndarray, m: int) -> np.ndarray:
    """Rows of parity bits (32 to a number), folded to m bits."""
    while bits.shape[-1] * 32 > m:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def bands(n, t: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """The band of a set of n, and that of its smallest partner."""
    return np.searchsorted(_FLOORS, n, side="right") - 1, np.searchsorted(_FLOORS, np.ceil(t * np.asarray(n) - 1e-6), side="right") - 1


class Parts:
    """The parts of sets in their slots: of each its set, slot, size and parity bits, and the words of its prefix.

    ``common``, sorted by token, gives the tokens that stand last with their ranks.
    """

    def __init__(self, sets: list[np.ndarray], common: np.ndarray, t: float):
        own, low = bands([len(s) for s in sets], t)
        dealt = [(i, b) for i, (lo, hi) in enumerate(zip(low.tolist(), own.tolist())) for b in range(lo, hi + 1)]
        flat = np.concatenate([sets[i] for i, _ in dealt])
        which = np.repeat(np.arange(len(dealt)), [len(sets[i]) for i, _ in dealt])
        k = _SLOT_BITS[[b for _, b in dealt]]
        slot = np.where(k[which] > 0, (flat >> (64 - np.maximum(k, 1)).astype(np.uint64)[which]).astype(np.int64), 0)
        group = which * SLOTS + slot  # sets are sorted by hash, so groups are runs
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        self.n = np.diff(np.concatenate((start, [len(flat)])))
        which = which[start]
        self.owner = np.array([i for i, _ in dealt])[which]
        self.slot = slot[start] + _FIRST[[b for _, b in dealt]][which]
        self.whole = size_level(np.array([len(sets[i]) for i, _ in dealt]))[which]
        part = np.repeat(np.arange(len(start)), self.n)
        token, rank = common["token"], common["rank"]
        place = (flat >> np.uint64(20)) & np.uint64((1 << 39) - 1)
        if len(token):
            at = np.minimum(np.searchsorted(token, flat), len(token) - 1)
            late = token[at] == flat
            place[late] = rank[at[late]].astype(np.uint64) | np.uint64(1 << 39)
        order = np.argsort((part.astype(np.uint64) << np.uint64(40)) | place, kind="stable")  # equal places keep the order of hashes
        nth = np.arange(len(flat)) - start[part]
        keep = nth < prefix_length(self.n, t)[part]
        self.word, self.part = flat[order[keep]], part[keep]
        self.left = self.n[self.part] - nth[keep]
        self.length = level(self.n) // 32
        self.bits, self.begin = parity(flat, part, self.length * 32)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list, list[str]]]:
    """Columns of a batch, cut to so many characters that the arrays stay small."""
    src, key, text = (batch.column(c).to_pylist() for c in ("src", "row_key", "text"))
    a = size = 0
    for i, t in enumerate(text):
        size += len(t)
        if size > SLICE_CHARS or i - a > 2000:
            if i > a:
                yield src[a:i], key[a:i], text[a:i]
                a, size = i, len(t)
    if a < len(text):
        yield src[a:], key[a:], text[a:]


COMMON = np.dtype([("token", np.uint64), ("rank", np.int64)])
SURVEY = "src string, row_key bigint, n int, bits binary, sum bigint, xor bigint, code bigint, token bigint, hits bigint"
_SURVEY = pa.schema([("src", pa.string()), ("row_key", pa.int64()), ("n", pa.int32()), ("bits", pa.binary()), *((c, pa.int64()) for c in ("sum", "xor", "code", "token", "hits"))])
#: Bits a token of the sketch of a whole record.
WHOLE_BITS = 1.5


def _marks(s: np.ndarray) -> tuple[int, int, int]:
    """The size of a set and two hashes of it: equal for equal sets."""
    return len(s), int(s.sum()), int(np.bitwise_xor.reduce(mix(s)))


def _codes(src: np.ndarray, n: np.ndarray, total: np.ndarray, xor: np.ndarray) -> np.ndarray:
    """The hash of a class: of a source's number and the marks of a set, as uint64."""
    return mix(total + mix(xor + mix(n + mix(src + np.uint64(1)))))


def _columns(rows: list[tuple]) -> list[np.ndarray]:
    """Columns of (source number, *marks) as uint64."""
    return [np.array(c, dtype=np.uint64) for c in zip(*rows)]


def survey(texts: DataFrame, sources: list[str], run: int, least: int, share: float = COMMON_SHARE) -> DataFrame:
    """One pass over ``texts`` (src, row_key, text): a row of size, parity bits, hashes and code for every record, and rows (token, hits)
    of the tokens that lossy counting finds on many records of a partition.

    A token on more than ``share`` of the records is over it in some partition; of a partition at most (tokens a
    record / share) can be. The tokens found steer the join's cost, never its result's exactness.
    """
    number = {s: i for i, s in enumerate(sources)}

    def rows_of(rows: int, **given: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(rows, f.type)) for f in _SURVEY], schema=_SURVEY)

    def signed(a: np.ndarray) -> pa.Array:
        return pa.array(a.view(np.int64))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
        fresh: list[np.ndarray] = []
        size = records = 0

        def merge() -> tuple[np.ndarray, np.ndarray]:
            k = np.concatenate([held[0], *fresh])
            n = np.concatenate([held[1], np.ones(len(k) - len(held[0]), dtype=np.int64)])
            order = np.argsort(k)
            k, n = k[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, dtype=np.int64)
            k, n = k[first], np.add.reduceat(n, first) if len(first) else n
            keep = n > max(1, share * records / 4)
            return k[keep], n[keep]

        for b in batches:
            for src, key, text in _slices(b):
                found = [(s, k, x) for s, k, x in zip(src, key, token_sets(text, run, least)) if x is not None]
                if not found:
                    continue
                records += len(found)
                fresh += [x for _, _, x in found]
                size += sum(len(x) for _, _, x in found)
                s, n, total, xor = _columns([(number[s], *_marks(x)) for s, _, x in found])
                m = level(n.astype(np.int64), WHOLE_BITS)
                bits, begin = parity(np.concatenate([x for _, _, x in found]), np.repeat(np.arange(len(found)), n.astype(np.int64)), m)
                yield rows_of(
                    len(found), src=pa.array([x[0] for x in found]), row_key=pa.array([x[1] for x in found], pa.int64()), n=pa.array(n.astype(np.int32)),
                    bits=pa.array([bits[a : a + k].tobytes() for a, k in zip(begin, m // 32)], pa.binary()), sum=signed(total), xor=signed(xor), code=signed(_codes(s, n, total, xor)),
                )
                if size > 2_000_000:
                    held, fresh, size = merge(), [], 0
        k, n = merge()
        top = n >= max(4, share * records / 2)
        if top.any():
            yield rows_of(int(top.sum()), token=signed(k[top]), hits=pa.array(n[top]))

    return texts.mapInArrow(make, SURVEY)


def common_tokens(surveyed: DataFrame) -> np.ndarray:
    """The most frequent tokens found, ``COMMON_TOKENS`` at most, sorted by token, with their ranks by count."""
    got = surveyed.where("token is not null").groupBy("token").agg(F.sum("hits").alias("hits")).where(F.col("hits") >= COMMON_LEAST)
    table = got.orderBy(F.desc("hits"), "token").limit(COMMON_TOKENS).toPandas()  # the bound of what is broadcast; the others keep their place by hash
    token = table["token"].to_numpy(dtype=np.int64).view(np.uint64)
    out = np.empty(len(token), dtype=COMMON)
    out["token"], out["rank"] = token, np.arange(len(token))[::-1]
    return np.sort(out, order="token")


BUCKETS = "bucket int, codes binary, wholes binary, sizes binary, counts binary, bits binary, words binary, left binary"
_BUCKETS = ("bucket", "codes", "wholes", "sizes", "counts", "bits", "words", "left")


def _narrow(a: np.ndarray) -> bytes:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32).tobytes()


def _wide(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, dtype={0: np.uint8, 1: np.uint8, 2: np.uint16, 4: np.uint32}[len(blob) // n if n else 0]).astype(np.int64)


def _ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of runs that begin and are as long as given, one after the other."""
    return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def pack(texts: DataFrame, sources: list[str], common: np.ndarray, split: list[int], wide: bool, run: int, least: int, t: float) -> DataFrame:
    """The prefixes of the records' parts by bucket, as many a slot as ``split`` says of its band; equal sets that are packed together are packed once."""
    shipped = texts.sparkSession.sparkContext.broadcast(common)
    number = {s: i for i, s in enumerate(sources)}
    splits = np.repeat(split, 1 << _SLOT_BITS)
    firsts = np.cumsum(splits) - splits

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            parts, words = np.cumsum([0] + [len(p.n) for p, _, _ in held]), np.cumsum([0] + [len(p.bits) for p, _, _ in held])
            n, whole = np.concatenate([p.n for p, _, _ in held]), np.concatenate([p.whole for p, _, _ in held])
            slot = np.concatenate([p.slot for p, _, _ in held])
            code = np.concatenate([c[p.owner] for p, _, c in held])
            salt = np.concatenate([mix(s + np.uint64(1))[p.owner] for p, s, _ in held])
            begin, length = np.concatenate([p.begin + a for (p, _, _), a in zip(held, words)]), np.concatenate([p.length for p, _, _ in held])
            bits = np.concatenate([p.bits for p, _, _ in held])
            part = np.concatenate([p.part + a for (p, _, _), a in zip(held, parts)])
            left = np.concatenate([p.left for p, _, _ in held])
            w = mix(np.concatenate([p.word for p, _, _ in held]) + salt[part])
            slot = slot[part]
            bucket = firsts[slot] + ((w >> np.uint64(32)) % splits[slot].astype(np.uint64)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(int(splits.sum()) + 1))
            for k in np.flatnonzero(edges[1:] > edges[:-1]):
                i = order[edges[k] : edges[k + 1]]
                p = part[i]
                new = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
                u = p[new]
                row = (
                    (code[u] if wide else code[u].astype(np.uint32)).tobytes(), whole[u].astype(np.uint8).tobytes(), _narrow(n[u]), _narrow(np.diff(np.concatenate((new, [len(p)])))), bits[_ragged(begin[u], length[u])].tobytes(),
                    w[i].astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :3].tobytes(), _narrow(left[i]),
                )
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in row)], names=list(_BUCKETS))

        for b in batches:
            for src, _, text in _slices(b):
                found = [(number[s], x) for s, x in zip(src, token_sets(text, run, least)) if x is not None]
                if not found:
                    continue
                marks = [(s, *_marks(x)) for s, x in found]
                fresh = [i for i, c in enumerate(marks) if not (c in seen or seen.add(c))]
                if not fresh:
                    continue
                p = Parts([found[i][1] for i in fresh], shipped.value, t)
                s, n, total, xor = _columns([marks[i] for i in fresh])
                held.append((p, s, _codes(s, n, total, xor)))
                size += len(p.word)
                if size > PACKED or len(seen) > PACKED_RECORDS:
                    yield from flush()
                    seen, held, size = set(), [], 0
        if held:
            yield from flush()

    return texts.mapInArrow(make, BUCKETS)


def _candidates(rows: list[dict], t: float, wide: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the records of a bucket that share a word of a prefix and whose slots' parity bits aren't too far apart."""
    code = np.concatenate([np.frombuffer(r["codes"], dtype=np.uint64 if wide else np.uint32) for r in rows]).astype(np.uint64)
    held = [len(r["codes"]) // (8 if wide else 4) for r in rows]
    n = np.concatenate([_wide(r["sizes"], k) for r, k in zip(rows, held)])
    whole = np.concatenate([np.frombuffer(r["wholes"], dtype=np.uint8) for r in rows]).astype(np.int64)
    apart = math.floor(-math.log(t) / math.log(SIZE_STEP)) + 1  # levels of sets whose sizes are t to 1; the last level is open
    count = np.concatenate([_wide(r["counts"], k) for r, k in zip(rows, held)])
    bits = np.concatenate([np.frombuffer(r["bits"], dtype=np.uint32) for r in rows])
    m = level(n)
    begin = np.cumsum(m // 32) - m // 32
    b3 = np.frombuffer(b"".join(r["words"] for r in rows), dtype=np.uint8).reshape(-1, 3)
    word = np.zeros((len(b3), 4), dtype=np.uint8)
    word[:, :3] = b3
    word = word.view(np.uint32)[:, 0].astype(np.uint64)
    left = np.concatenate([_wide(r["left"], len(r["words"]) // 3) for r in rows])
    # of equal sets one: the same code with the same words here
    content = mix(code) + np.add.reduceat(mix(word + np.uint64(1)), np.cumsum(count) - count)
    only = np.zeros(len(code), dtype=bool)
    only[np.unique(content, return_index=True)[1]] = True
    part = np.repeat(np.arange(len(code)), count)
    keep = only[part]
    word, part, left = word[keep], part[keep], left[keep]

    key = (word << np.uint64(32)) | n[part].astype(np.uint64)
    order = np.argsort(key)
    key, part, left = key[order], part[order], left[order]
    # of a pair's smaller part: the largest size with which it can still share enough
    most = np.floor(left * (1 + t) / t - n[part] + 1e-6).astype(np.int64)
    i = np.flatnonzero(most >= n[part])
    high = np.uint64(0xFFFFFFFF)
    end = np.searchsorted(key, (key[i] & ~high) | np.minimum(most[i], int(high)).astype(np.uint64), side="right")
    i, count = i[end - i > 1], (end - i - 1)[end - i > 1]
    total = np.cumsum(count)
    a = 0
    while a < len(i):
        b = max(a + 1, int(np.searchsorted(total, total[a] - count[a] + TESTED, side="right")))
        x = np.repeat(i[a:b], count[a:b])
        y = x + 1 + np.arange(len(x)) - np.repeat(total[a:b] - count[a:b] - (total[a] - count[a]), count[a:b])
        a = b
        p, q = part[x], part[y]
        ok = (left[y] >= t / (1 + t) * (n[p] + n[q]) - 1e-6) & ((np.abs(whole[p] - whole[q]) <= apart) | (whole[p] == 255) | (whole[q] == 255))
        p, q = p[ok], q[ok]
        near = np.zeros(len(p), dtype=bool)
        combination = m[p] * (1 << 32) + m[q]
        for c in np.unique(combination):
            j = np.flatnonzero(combination == c)
            mp, mq = int(c) >> 32, int(c) & 0xFFFFFFFF
            step = max(1, TESTED * 512 // max(mp, mq))
            for k in range(0, len(j), step):
                z = j[k : k + step]
                u, v = (fold(bits[begin[r[z]][:, None] + np.arange(o // 32)], min(mp, mq)) for r, o in ((p, mp), (q, mq)))
                near[z] = np.bitwise_count(u ^ v).sum(axis=1, dtype=np.int64) <= bound(n[p[z]], n[q[z]], t) + 1e-9
        p, q = code[p[near]], code[q[near]]
        pair = np.unique(np.stack((np.minimum(p, q), np.maximum(p, q)), axis=1)[p != q], axis=0)
        yield pair[:, 0], pair[:, 1]


def _pairs(t: float, wide: bool):
    """Candidates of a partition's buckets, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def emit() -> Iterator[pa.RecordBatch]:
            for a, b in _candidates(held, t, wide):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a.copy(), b.copy())], names=["a", "b"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from emit()
                    held = []
                held.append(row)
        if held:
            yield from emit()

    return run


def _close(t: float):
    """The pairs whose whole records' parity bits aren't too far apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [b.column(f"n_{c}").to_numpy(zero_copy_only=False).astype(np.int64) for c in "ab"]
            bits = [b.column(f"bits_{c}").to_pylist() for c in "ab"]
            keep = np.zeros(b.num_rows, dtype=bool)
            size = np.stack([[len(x) for x in side] for side in bits]) if b.num_rows else np.zeros((2, 0), dtype=np.int64)
            for i, j in {(int(i), int(j)) for i, j in size.T}:
                z = np.flatnonzero((size[0] == i) & (size[1] == j))
                u, v = (fold(np.frombuffer(b"".join([side[k] for k in z]), dtype=np.uint32).reshape(len(z), -1), 8 * min(i, j)) for side in bits)
                keep[z] = np.bitwise_count(u ^ v).sum(axis=1, dtype=np.int64) <= bound(n[0][z], n[1][z], t) + 1e-9
            yield b.select(["src", "key_a", "key_b"]).filter(pa.array(keep))

    return run


def _alike(t: float, run_length: int, least: int):
    """The exact likeness of pairs of texts; each text of a batch is read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = {}
            for side in "ab":
                text.update(zip(b.column(f"key_{side}").to_pylist(), b.column(f"text_{side}").to_pylist()))
            keys, sets, size, first = list(text), {}, 0, 0
            for i, k in enumerate(keys):
                size += len(text[k])
                if size > SLICE_CHARS or i == len(keys) - 1:
                    part = keys[first : i + 1]
                    sets.update(zip(part, token_sets([text[x] for x in part], run_length, least)))
                    first, size = i + 1, 0
            score = []
            for x, y in zip(b.column("key_a").to_pylist(), b.column("key_b").to_pylist()):
                p, q = sets[x], sets[y]
                both = len(np.intersect1d(p, q, assume_unique=True)) if p is not None and q is not None else -1
                score.append(both / (len(p) + len(q) - both) if both >= 0 else -1.0)
            keep = pa.array([s >= t - 1e-12 for s in score], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("src"), b.column("key_a"), b.column("key_b"), pa.array(score, pa.float64())], names=["src", "key_a", "key_b", "likeness"]).filter(keep)

    return run


def near_duplicates(texts: DataFrame, sources: list[str], threshold: float = THRESHOLD, run: int = RUN, least: int = LEAST_WORDS) -> tuple[DataFrame, DataFrame]:
    """(links, classes) of ``texts`` (src, row_key, text), whose src are among ``sources``.

    links: src, key_a, key_b, likeness between representatives of different classes;
    classes: src, row_key, rep, members, of the classes of more than one record.
    """
    texts = texts.select("src", "row_key", "text").where("text is not null and row_key is not null").where(F.col("src").isin(*sources))
    made = stage(survey(texts, sources, run, least), "neardup-survey")
    records = made.where("row_key is not null")
    marks = ["src", "n", "sum", "xor"]
    reps = records.groupBy(*marks).agg(F.min("row_key").alias("rep"), F.max("code").alias("code"), F.max("bits").alias("bits"), F.countDistinct("row_key").alias("members"))
    reps = stage(reps, "neardup-classes")
    classes = records.select(*marks, "row_key").distinct().join(reps.where("members > 1"), marks).select("src", "row_key", "rep", "members")
    ends = [*_FLOORS[1:].tolist(), 1 << 62]
    tokens = [F.coalesce(F.sum(F.when((F.col("n") >= int(lo)) & (F.col("n") * threshold < hi), F.col("n"))), F.lit(0)).alias(f"t{b}") for b, (lo, hi) in enumerate(zip(_FLOORS.tolist(), ends))]
    size = records.agg(F.count("*").alias("records"), *tokens).first()
    split = [max(1, math.ceil((1 - threshold) * size[f"t{b}"] / (1 << k) / BUCKET)) for b, (_, k) in enumerate(BANDS)]
    wide = size["records"] > NARROW_CODES
    packed = pack(texts, sources, common_tokens(made), split, wide, run, least, threshold)
    met = packed.repartition(sum(s << k for s, (_, k) in zip(split, BANDS)), "bucket").sortWithinPartitions("bucket")
    codes = stage(met.mapInArrow(_pairs(threshold, wide), "a bigint, b bigint").distinct(), "neardup-codes")
    named = reps.select("src", "rep", "n", "bits", (F.col("code") if wide else F.col("code").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))).alias("code"))
    # classes that share a code are candidates of each other
    shared = named.groupBy("code").agg(F.count("*").alias("sharers")).where("sharers > 1").select(F.col("code").alias("a"), F.col("code").alias("b"))
    side = lambda c: named.select(F.col("code").alias(c), F.col("src").alias(f"src_{c}"), F.col("rep").alias(f"rep_{c}"), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    near = codes.unionByName(shared).join(side("a"), "a").join(side("b"), "b").where((F.col("src_a") == F.col("src_b")) & (F.col("rep_a") != F.col("rep_b")) & (F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b") - 1e-6))
    near = near.select(F.col("src_a").alias("src"), F.least("rep_a", "rep_b").alias("key_a"), F.greatest("rep_a", "rep_b").alias("key_b"), "n_a", "n_b", "bits_a", "bits_b")
    near = stage(near.mapInArrow(_close(threshold), "src string, key_a bigint, key_b bigint").distinct(), "neardup-near")
    needed = near.select("src", F.col("key_a").alias("row_key")).union(near.select("src", "key_b")).distinct()
    kept = stage(texts.join(needed, ["src", "row_key"], "left_semi"), "neardup-texts")
    text = lambda c: kept.select("src", F.col("row_key").alias(f"key_{c}"), F.col("text").alias(f"text_{c}"))
    both = near.join(text("a"), ["src", "key_a"]).join(text("b"), ["src", "key_b"]).select("src", "key_a", "key_b", "text_a", "text_b")
    links = both.mapInArrow(_alike(threshold, run, least), "src string, key_a bigint, key_b bigint, likeness double")
    return links.groupBy("src", "key_a", "key_b").agg(F.max("likeness").alias("likeness")), classes


def expand(links: DataFrame, classes: DataFrame, most: int = EXPANDED) -> DataFrame:
    """(src, key_a, key_b): the links of representatives and the classes as pairs of records."""
    small = classes.where(F.col("members") <= most)
    m = small.select("src", F.col("rep").alias("key"), F.col("row_key").alias("member"))
    a = links.select("src", "key_a", "key_b").join(m.withColumnsRenamed({"key": "key_a", "member": "member_a"}), ["src", "key_a"], "left")
    ab = a.join(m.withColumnsRenamed({"key": "key_b", "member": "member_b"}), ["src", "key_b"], "left")
    x, y = F.coalesce("member_a", "key_a"), F.coalesce("member_b", "key_b")
    between = ab.select("src", F.least(x, y).alias("key_a"), F.greatest(x, y).alias("key_b"))
    p, q = small.alias("p"), small.alias("q")
    inside = p.join(q, (F.col("p.src") == F.col("q.src")) & (F.col("p.rep") == F.col("q.rep")) & (F.col("p.row_key") < F.col("q.row_key")))
    inside = inside.select("p.src", F.col("p.row_key").alias("key_a"), F.col("q.row_key").alias("key_b"))
    star = classes.where((F.col("members") > most) & (F.col("row_key") != F.col("rep"))).select("src", F.col("rep").alias("key_a"), F.col("row_key").alias("key_b"))
    return between.unionByName(inside).unionByName(star)
