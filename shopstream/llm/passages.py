"""Fuzzy repeated passages by collinear chaining.

A passage is a run of at least ``min_words`` words that another document has too,
with at most a share 1 - ``min_identity`` of differing words.

1. *Seeds.* Winnowing: of every ``window`` consecutive k-mers of words (``K`` words each)
   the one with the smallest hash is a seed, so any run of ``K + window - 1``
   equal words has a common seed. A seed carries the 16 words on either side, four bits each.
2. *Links.* One shuffle by seed, sorted by document. Each occurrence is linked to the
   first document that has the seed and to the nearest one before its own, the n-th
   occurrence in a document to the n-th in the other; and to the nearest ones before in which
   also the carried words after it, before it, or both agree. Five rows at most, never all pairs.
   The others than the first find passages of which earlier documents have parts: the last three
   also where many documents hold the seed and few what is around it. Seeds that very many documents hold (found in a sample of the
   documents) are dealt to buckets first, ranges of documents in their order, so no group grows with the corpus.
   A bucket also gets the documents before it that its own are linked to: the seed's first one, the
   last one of all, and the last ones with the words around that a document of the bucket has.
   So the links are those of the whole group.
3. *Chaining.* For a document and a linked one, anchors (position, other position) are
   chained in ascending order of both with gap cost ``GAP`` for each word skipped on
   either side. The best predecessor is a maximum over a prefix of other positions,
   kept in a Fenwick tree. Gaps too costly begin a new chain. A chain of one anchor
   beside which the carried words show that no alignment goes on can't reach
   ``min_words`` and ends here; four bits may take different words for equal, never
   equal ones for different.
4. *Alignment.* Documents are cut into tiles of word hashes; each chain left fetches the
   tiles of its two ranges with a margin. Between anchors words are aligned by edit
   distance, outside by extension; what reaches length and identity is a passage. A
   chain under the identity is cut at gaps into the longest pieces that have it.

The result names the later document and the one that has the passage too, so
every document that repeats a passage of an earlier one is found. A passage is left
out only where another row of the document shows a run
of equal words over all of it: the document named there has the same words. Inside
a fuzzy passage that need not hold, so other passages in one have their rows: every chain is
aligned, also one in the range of another. Copies are a few rows each at most, not all their pairs.

Defined cases: null or empty texts and texts shorter than a passage have none; rows
without ``doc_id`` are left out, as pairs could not name them; different texts that
share a ``doc_id`` are documents of their own, in the order of a hash of the text (a row
may then name one id twice); rows with the same ``doc_id`` and text are one document;
repeats inside one document are not reported, so where it says a few words over and over the
first and the last places that correspond are aligned, not every shift; an empty table gives an empty result;
other columns are ignored; results do not depend on the order or partitions of the rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, as_bytes, mix64, ready, slices, tidy
from shopstream.llm.words import word_hashes

K = 6
WINDOW = 16
MIN_WORDS = 50
MIN_IDENTITY = 0.8
GAP = 0.1
#: Words fetched on both sides of a chain for its extension, beyond the document's other chains there.
MARGIN = 48
TILE = 256

_U = np.uint64
_TURN = mix64(np.arange(1, 65, dtype=_U)) | _U(1)
PASSAGE_SCHEMA = ("doc_id long, other_id long, begin int, end int, other_begin int, other_end int, n_words int, "
                  "n_equal int, identity double")


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = op(x[:len(x) - step], x[step:])
        have += step
    return x


def seeds_of(h: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the seeds of one text's words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    grams = np.zeros(n, _U)
    for i in range(k):
        grams += h[i:i + n] * _TURN[i]
    grams = mix64(grams)
    if n <= window:
        chosen = grams == grams.min()
    else:
        low = _sliding(grams, window, np.minimum)  # least of each window
        wide = np.concatenate([np.zeros(window - 1, _U), low, np.zeros(window - 1, _U)])
        chosen = _sliding(wide, window, np.maximum)[:n] == grams
    at = np.flatnonzero(chosen)
    return at, grams[at]


def chain_anchors(x: np.ndarray, y: np.ndarray, k: int = K, gap: float = GAP) -> list[np.ndarray]:
    """Collinear chains of anchors (x ascending; ties in any order), as index arrays.

    score(i) = k + max(0, max over j with x_j < x_i and y_j < y_i of
    score(j) - gap * ((x_i - x_j) + (y_i - y_j))); the sum splits into a part of j
    and a part of i, so the inner maximum is a prefix maximum over y.
    """
    n = len(x)
    if n == 1:
        return [np.zeros(1, np.int64)]
    xs, ys = x.tolist(), (np.unique(y, return_inverse=True)[1].ravel() + 1).tolist()
    key = (gap * (x + y)).tolist()
    size = max(ys)
    tree_best, tree_from = [0.0] * (size + 1), [-1] * (size + 1)
    score, before = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and xs[j] == xs[i]:  # equal x can't follow each other: ask all, then store all
            best, source, at = 0.0, -1, ys[j] - 1
            while at > 0:
                if tree_from[at] >= 0 and (source < 0 or tree_best[at] > best):
                    best, source = tree_best[at], tree_from[at]
                at &= at - 1
            gain = best - key[j] if source >= 0 else 0.0
            score[j], before[j] = (k + gain, source) if gain > 0 else (float(k), -1)
            j += 1
        for m in range(i, j):
            value, at = score[m] + key[m], ys[m]
            while at <= size:
                if tree_from[at] < 0 or value > tree_best[at]:
                    tree_best[at], tree_from[at] = value, m
                at += at & -at
        i = j
    used, out = [False] * n, []
    for end in np.argsort(-np.array(score), kind="stable").tolist():
        if used[end]:
            continue
        chain, at = [], end
        while at >= 0 and not used[at]:
            used[at] = True
            chain.append(at)
            at = before[at]
        out.append(np.array(chain[::-1]))
    return out


def _edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words in a best alignment of two short runs (longest common subsequence)."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    if not len(differ):
        return n
    # Equal words at both ends belong to a best alignment: mostly a word or two are left between them.
    head = int(differ[0])
    back = np.flatnonzero(a[len(a) - n + head:][::-1] != b[len(b) - n + head:][::-1])
    tail = int(back[0]) if len(back) else n - head
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if min(len(a), len(b)) < 2:
        return head + tail + int(len(a) > 0 < len(b) and (a == b if len(a) == len(b) else np.isin(a, b)).any())
    if len(a) > len(b):
        a, b = b, a
    row = np.zeros(len(b) + 1, np.int64)
    for w in a:
        diagonal = row[:-1] + (b == w)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], diagonal))
    return head + tail + int(row[-1])


def _extend(a: np.ndarray, b: np.ndarray, drop: int = 6) -> list[tuple[int, int, int]]:
    """Steps from the starts of a and b that align well: (differing words of a, of b, equal words after them).

    Equal words first; then steps over up to three differing words on either side
    as long as three equal words follow, until ``drop`` more differ than agree.
    """
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    i = j = int(differ[0]) if len(differ) else n
    out = [(0, 0, i)]
    debt = 0
    while i < len(a) and j < len(b) and debt < drop:
        for p, q in ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (3, 3), (2, 0), (0, 2)):
            x, y = a[i + p:i + p + 3], b[j + q:j + q + 3]
            if len(x) == 3 and len(y) == 3 and (x == y).all():
                break
        else:
            break
        debt += max(p, q)
        i, j = i + p, j + q
        m = min(len(a) - i, len(b) - j)
        differ = np.flatnonzero(a[i:i + m] != b[j:j + m])
        run = int(differ[0]) if len(differ) else m
        i, j, debt = i + run, j + run, max(0, debt - run)
        out.append((p, q, run))
    return out


def _forward(runs: list[list[int]], a: np.ndarray, b: np.ndarray) -> None:
    """Extend the last of ``runs`` (begin, end, other begin, other end, equal words before it since the run before)."""
    i, j = runs[-1][1], runs[-1][3]
    for p, q, run in _extend(a[i:], b[j:]):
        if not p and not q:
            runs[-1][1], runs[-1][3] = i + run, j + run
        else:
            runs.append([i + p, i + p + run, j + q, j + q + run, 0])
        i, j = i + p + run, j + q + run


def _backward(i: int, j: int, a: np.ndarray, b: np.ndarray) -> list[list[int]]:
    """Runs that end before (i, j), the last one first; equal words right before (i, j) make a run too."""
    out = []
    for p, q, run in _extend(a[:i][::-1], b[:j][::-1]):
        i, j = i - p, j - q
        out.append([i - run, i, j - run, j, 0])
        i, j = i - run, j - run
    return out


def _runs(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, fine: bool, k: int = K) -> list[list[int]]:
    """Runs of equal words along a chain, in order: (begin, end, other begin, other end, equal words of the gap before).

    ``fine``: runs are also extended into the gaps between anchors.
    """
    runs = _backward(int(x[0]), int(y[0]), a, b)[::-1]
    i, j = int(x[0]), int(y[0])
    p, q = int(x[-1]) + k, int(y[-1]) + k
    if p - i == q - j and (a[i:p] == b[j:q]).all():  # the whole chain is one run of equal words
        runs[-1][1], runs[-1][3] = p, q
        _forward(runs, a, b)
        return runs
    for p, q in zip(x.tolist(), y.tolist()):
        if p - i == q - j and (p < i or (a[i:p + k] == b[j:q + k]).all()):
            runs[-1][1], runs[-1][3] = p + k, q + k  # the common case: nothing differs since the last anchor
        elif p >= i and q >= j:
            left = []
            if fine:
                _forward(runs, a[:p], b[:q])
                i, j = runs[-1][1], runs[-1][3]
                left = [[u + i, v + i, s + j, t + j, 0] for u, v, s, t, _ in _backward(p - i, q - j, a[i:p], b[j:q])][::-1]
                p, q, end, other_end = left[0][0], left[0][2], p, q
            gap = _edit_matches(a[i:p], b[j:q])
            if fine:
                left[0][4] = gap
                left[-1][1], left[-1][3] = end + k, other_end + k
                runs += left
                p, q = end, other_end
            else:
                runs.append([p, p + k, q, q + k, gap])
        else:  # the anchor overlaps the one before on another diagonal: count its new words
            new = min(p + k - i, q + k - j)
            runs.append([p + k - new, p + k, q + k - new, q + k, 0])
        i, j = max(i, p + k), max(j, q + k)
    _forward(runs, a, b)
    return runs


def _pieces(runs: list[list[int]], min_words: int, min_identity: float) -> list[tuple[int, int, int, int, int]]:
    """The longest run of runs with the identity, then the longest ones on both sides of it, and so on."""
    r = np.array(runs, np.int64)
    before = np.cumsum(r[:, 4] + np.append(0, r[:-1, 1] - r[:-1, 0]))  # equal words before each run
    after = before + r[:, 1] - r[:, 0]
    # A piece from run i to run j has the identity if high[j] >= low[i] on both sides.
    low = [before - min_identity * r[:, c] for c in (0, 2)]
    high = [after - min_identity * r[:, c] + 1e-9 for c in (1, 3)]
    todo, out = [(0, len(r))], []
    while todo:
        begin, end = todo.pop()
        if begin >= end or min(r[end - 1, 1] - r[begin, 0], r[end - 1, 3] - r[begin, 2]) < min_words:
            continue
        # Gaps that no piece can bridge, whatever it begins and ends with.
        cut = np.zeros(end - begin - 1, bool)
        for lo, hi in zip(low, high):
            cut |= np.maximum.accumulate(hi[begin + 1:end][::-1])[::-1] < np.minimum.accumulate(lo[begin:end - 1])
        if cut.any():
            at = [begin, *(begin + 1 + np.flatnonzero(cut)).tolist(), end]
            todo += zip(at, at[1:])
            continue
        best, first, last = 0, 0, 0
        for i in range(begin, end):
            if min(r[end - 1, 1] - r[i, 0], r[end - 1, 3] - r[i, 2]) <= best:
                break
            fits = np.flatnonzero((high[0][i:end] >= low[0][i]) & (high[1][i:end] >= low[1][i]))
            j = i + int(fits[-1]) if len(fits) else i
            n = int(min(r[j, 1] - r[i, 0], r[j, 3] - r[i, 2]))
            if n > best:
                best, first, last = n, i, j
        if best >= min_words:
            out.append((int(r[first, 0]), int(r[last, 1]), int(r[first, 2]), int(r[last, 3]),
                        int(after[last] - before[first])))
            todo += [(begin, first), (last + 1, end)]
    return sorted(out)


def align_chain(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, min_words: int = MIN_WORDS,
                min_identity: float = MIN_IDENTITY) -> list[tuple[int, int, int, int, int, list[tuple[int, int]]]]:
    """(begin, end, other begin, other end, equal words, runs) of a chain's passages in word arrays a and b.

    The runs are (begin, end) of ``min_words`` equal words and more in a row.

    One, if all of the chain has the identity; otherwise it is cut at gaps and its pieces are passages.
    """
    for fine in (False, True):
        runs = _runs(a, b, x, y, fine)
        p, q, u, v = runs[0][0], runs[-1][1], runs[0][2], runs[-1][3]
        n = min(q - p, v - u)
        if n < min_words:
            return []
        equal = sum(r[1] - r[0] + r[4] for r in runs)
        if equal >= min_identity * max(q - p, v - u):
            found = [(p, q, u, v, equal)]
            break
    else:
        found = _pieces(runs, min_words, min_identity)
    long = [r[:2] for r in runs if r[1] - r[0] >= min_words and (a[r[0]:r[1]] == b[r[2]:r[3]]).all()] if found else []
    return [(*row, [(p, q) for p, q in long if row[0] <= p and q <= row[1]]) for row in found]


# ---------------------------------------------------------------- words beside a seed

#: Words kept on either side of a seed, four bits each (0 beyond the text).
_SIDE = 16
#: Lowest bit of each group of four.
_LOW = _U(0x1111111111111111)
#: The steps over differing words that ``_extend`` tries.
_STEPS = ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (3, 3), (2, 0), (0, 2))


def beside(texts: list[np.ndarray], at: list[np.ndarray], k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words before and after the seeds at ``at`` of each text, nearest word in the lowest bits."""
    size = np.array([len(h) for h in texts])
    first = np.cumsum(size + _SIDE) - size  # no words before and between the texts
    code = np.zeros(int((size + _SIDE).sum()) + _SIDE, _U)
    place = np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)
    code[place] = (np.concatenate(texts) >> _U(60)) % _U(15) + _U(1)
    after, before = code, code.copy()
    for width in (1, 2, 4, 8):
        after = after | np.append(after[width:], np.zeros(width, _U)) << _U(4 * width)
        before = before | np.append(np.zeros(width, _U), before[:-width]) << _U(4 * width)
    seed = np.concatenate(at) + np.repeat(first, [len(x) for x in at])
    return before[seed - 1], after[seed + k]


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest bit of each group of four in which a and b agree."""
    x = a ^ b
    x |= x >> _U(2)
    x |= x >> _U(1)
    return ~x & _LOW


def run_and_end(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal words next to two seeds on one side, and whether an alignment surely ends after them."""
    differ = ~_equal(a, b) & _LOW
    lowest = differ & (~differ + _U(1))
    run = np.where(differ == 0, _SIDE, np.log2(np.maximum(lowest, _U(1)).astype(np.float64)) / 4).astype(np.int64)
    # Different words may have one code and the run look longer: any step from within it counts.
    within = (_U(2) << _U(4) * np.minimum(run, _SIDE - 1).astype(_U)) - _U(1)
    on = run > _SIDE - 6  # the next words that count may lie beyond those kept
    for p, q in _STEPS:
        m = _equal(a >> _U(4 * p), b >> _U(4 * q))
        on |= (m & m >> _U(4) & m >> _U(8) & within) != 0
    return run, ~on


def bound_of_words(left_a, left_b, right_a, right_b, k: int = K) -> np.ndarray:
    """Equal words of an alignment through one seed where it surely ends on both sides, ``UNBOUND`` elsewhere."""
    (left, left_end), (right, right_end) = run_and_end(left_a, left_b), run_and_end(right_a, right_b)
    return np.where(left_end & right_end, left + k + right, UNBOUND).astype(np.int8)


UNBOUND = 127


# ---------------------------------------------------------------- Spark steps

def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """((doc_id, text hash), word hashes) of each text, and (None, None) at the end of a slice."""
    for batch in batches:
        for part in slices(batch, "text"):
            h, size = word_hashes(as_bytes(part.column("text")))
            ends = np.cumsum(size)
            for doc_id, th, a, b in zip(part.column("doc_id").to_pylist(), part.column("th").to_pylist(),
                                        (ends - size).tolist(), ends.tolist()):
                yield (doc_id, th), h[a:b]
            yield None, None


SEED_SCHEMA = "seed long, doc_id long, th int, pos int, before long, after long"


def _seeds(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, columns = [], []
        for name, h in _words(batches):
            if name is not None:
                if len(h) >= min_words:
                    at, seed = seeds_of(h)
                    ids.append((*name, len(at)))
                    columns.append((h, at, seed))
            elif ids:
                texts, at, seed = zip(*columns)
                before, after = beside(texts, at)
                at, seed = np.concatenate(at), np.concatenate(seed)
                doc, th, n = (np.array(c, np.int64) for c in zip(*ids))
                yield pa.RecordBatch.from_arrays([
                    pa.array(seed.view(np.int64)), pa.array(np.repeat(doc, n)), pa.array(np.repeat(th, n).astype(np.int32)),
                    pa.array(at.astype(np.int32)), pa.array(before.view(np.int64)), pa.array(after.view(np.int64))],
                    names=[c.split()[0] for c in SEED_SCHEMA.split(", ")])
                ids, columns = [], []
    return run


def _tiles(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, numbers, data = [], [], [], []
        for name, h in _words(batches):
            if name is not None:
                if len(h) >= min_words:
                    raw = (h >> _U(32)).astype("<u4").tobytes()
                    n = -(-len(h) // TILE)
                    ids += [name[0]] * n
                    hashes += [name[1]] * n
                    numbers += range(n)
                    data += [raw[4 * TILE * i:4 * TILE * (i + 1)] for i in range(n)]
            elif ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int32()),
                                                  pa.array(numbers, pa.int32()), pa.array(data, pa.binary())],
                                                 names=["doc_id", "th", "number", "words"])
                ids, hashes, numbers, data = [], [], [], []
    return run


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Columns, group begins and group ends of complete groups, from batches sorted by the first ``keys`` columns."""
    held: pa.Table | None = None
    def cut(table: pa.Table, final: bool):
        cols = [c.to_numpy() for c in table.columns[:keys]]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        begin = np.flatnonzero(new)
        return (begin, np.append(begin[1:], table.num_rows)) if final else (begin[:-1], begin[1:])
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        begin, end = cut(held, False)
        if len(begin):
            yield held.columns, begin, end
            held = held.slice(int(end[-1]))
    if held is not None and held.num_rows:
        yield (held.columns, *cut(held, True))


LINK_SCHEMA = "doc_id long, th int, other_id long, other_th int, pos int, other_pos int, bound byte"


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed, bucket, document and position: links to the first document, to the one before, and to the
    ones before with equal words around. Rows that are not the bucket's ``own`` are linked to only."""
    for cols, begin, end in whole_groups(batches, 2):
        seed, bucket, doc, th, pos, before, after = (c.to_numpy()[:end[-1]] for c in cols[:7])
        own = cols[7].to_numpy()[:end[-1]]
        n = len(seed)
        new_group = np.zeros(n, bool)
        new_group[begin] = True
        new_doc = new_group.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
        once = new_doc.copy()  # a repeated row has each seed again
        once[1:] |= pos[1:] != pos[:-1]
        new, old = np.flatnonzero(once), np.cumsum(once) - 1
        start = old[new_doc]  # each document's first row, of those that count
        seed, bucket, doc, th, pos, before, after, own, run = (
            x[new] for x in (seed, bucket, doc, th, pos, before, after, own, np.cumsum(new_doc) - 1))
        size = np.bincount(run)
        first = run[old[np.repeat(begin, end - begin)][new]]  # of each row's group
        use = np.flatnonzero((run != first) & own)

        nth = use - start[run[use]]
        over = np.append(np.diff(pos) < K, False)  # the next row overlaps this one, if it is of the same document
        between = over[use] & over[use - 1] & (nth + 1 < size[run[use]])

        def partner(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The n-th occurrence in a document belongs to the n-th in the other, the rest to its last; of a few words
            over and over, the first and the last of the rest."""
            return start[which] + np.minimum(nth, size[which] - 1), ~(between & (nth > size[which]))

        (hub, hub_use), (near, near_use) = partner(first[use]), partner(run[use] - 1)
        near_use &= first[use] != run[use] - 1
        at, to = [use[hub_use], use[near_use]], [hub[hub_use], near[near_use]]
        linked = [np.where(run == 0, -1, run - 1), first]  # documents by number that a row is linked to, or has no use for
        # Inside a few words over and over all places have equal words around: the links above are enough there.
        same = np.append(over[:-1] & (run[1:] == run[:-1]), False)
        apart = ~(same & np.append(False, same[:-1]))
        for words in ((after,), (before,), (before, after)):
            other = _before_with(first, words, run)
            there = other >= 0
            found = np.where(there, run[other], -1)
            new = apart & own & there & np.all([found != x for x in linked], axis=0)
            linked.append(found)
            at.append(np.flatnonzero(new))
            to.append(other[new])
        at, to = np.concatenate(at), np.concatenate(to)
        if len(at):
            left, right = before.view(_U), after.view(_U)
            bound = bound_of_words(left[at], left[to], right[at], right[to])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[at], th[at], doc[to], th[to], pos[at], pos[to], bound)],
                                             names=[c.split()[0] for c in LINK_SCHEMA.split(", ")])


EDGE_SCHEMA = "seed long, kind int, x long, y long, bucket int, doc_id long, th int, pos int, before long, after long"
#: Kinds of edges: the words by which documents are linked (none, after, before, both), and the first document.
_FIRST = 4


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by seed, bucket, document and position: what later buckets may be linked to. These are the bucket's
    first document, its last one, and for all words around a seed the last one that has them, whole."""
    for cols, begin, end in whole_groups(batches, 2):
        n = int(end[-1])
        seed, bucket, doc, th, pos, before, after = rows = [c.to_numpy()[:n] for c in cols[:7]]
        new_group = np.zeros(n, bool)
        new_group[begin] = True
        new_doc = new_group.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
        group, run = np.cumsum(new_group) - 1, np.cumsum(new_doc) - 1
        none = np.zeros(n, np.int64)
        for kind, x, y in ((0, none, none), (1, after, none), (2, before, none), (3, after, before), (_FIRST, none, none)):
            if kind == _FIRST:
                at = np.flatnonzero(run == run[begin][group])
            else:
                order = np.lexsort((run, y, x, group))
                new = np.append(True, np.any([c[order][1:] != c[order][:-1] for c in (group, x, y)], axis=0))
                last = np.append(np.flatnonzero(new)[1:], n) - 1
                at = order[run[order] == run[order][last][np.cumsum(new) - 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (seed[at], np.full(len(at), kind, np.int32), x[at], y[at], *(c[at] for c in rows[1:]))],
                names=[c.split()[0] for c in EDGE_SCHEMA.split(", ")])


SEEN_SCHEMA = "seed long, bucket int, doc_id long, th int, pos int, before long, after long"


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges sorted by seed, kind, words and bucket: those of the bucket before (of the first one: the first document)
    as rows of each bucket that has the words too."""
    for cols, begin, end in whole_groups(batches, 4):
        n = int(end[-1])
        seed, kind, _, _, bucket, *rows = (c.to_numpy()[:n] for c in cols)
        new_group = np.zeros(n, bool)
        new_group[begin] = True
        block = np.flatnonzero(new_group | np.append(True, bucket[1:] != bucket[:-1]))
        size = np.diff(np.append(block, n))
        leads = new_group[block]
        to = np.flatnonzero(~leads)
        first = np.maximum.accumulate(np.where(leads, np.arange(len(block)), 0))
        source = np.where(kind[block[to]] == _FIRST, first[to], to - 1)
        many = size[source]
        at = np.repeat(block[source] - np.cumsum(many) + many, many) + np.arange(many.sum())
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (seed[at], np.repeat(bucket[block[to]], many), *(c[at] for c in rows))],
                names=[c.split()[0] for c in SEEN_SCHEMA.split(", ")])


def _before_with(group: np.ndarray, words: tuple[np.ndarray, ...], run: np.ndarray) -> np.ndarray:
    """For each row its place in the nearest document before in its group that has equal words, -1 without one; the
    n-th row of a document belongs to the n-th of the other, the rest to its last.

    ``run`` numbers the documents in ascending order over all groups."""
    order = np.lexsort((run, *words, group))
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (group, *words)], axis=0)
    own = new.copy()  # the first row of a document among those with equal words
    own[1:] |= run[order][1:] != run[order][:-1]
    begin = np.flatnonzero(own)
    block = np.cumsum(own) - 1
    size = np.diff(np.append(begin, len(order)))
    nth = np.arange(len(order)) - begin[block]
    out = np.empty(len(order), np.int64)
    out[order] = np.where(new[begin][block], -1, order[begin[block - 1] + np.minimum(nth, size[block - 1] - 1)])
    return out


CHAIN_SCHEMA = ("doc_id long, th int, other_id long, other_th int, x0 int, x1 int, y0 int, y1 int, back int, ahead int, "
                "anchors binary")
_FAR = np.int64(1) << 32


def _chains(min_words: int):
    """Rows sorted by document, other document and positions: chains that may be part of a passage, each with the
    words before and after it over which the document goes on to have links, with any other one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, doc_begin, doc_end in whole_groups(batches, 2):
            n = int(doc_end[-1])
            doc, th, other, other_th, pos, other_pos, bound = (c.to_numpy()[:n] for c in cols[:7])
            new_doc = np.zeros(n, bool)
            new_doc[doc_begin] = True
            group = np.cumsum(new_doc) - 1
            # Where the document has links, with gaps that extension might bridge.
            place = pos + group * _FAR
            order = np.argsort(place, kind="stable")
            sorted_ = place[order]
            apart = np.append(True, sorted_[1:] > sorted_[:-1] + K + 2 * MARGIN)
            stretch = np.empty(n, np.int64)
            stretch[order] = np.cumsum(apart) - 1
            low = sorted_[apart]
            high = np.append(sorted_[np.flatnonzero(apart)[1:] - 1], sorted_[-1]) + K
            pair = new_doc.copy()
            pair[1:] |= (other[1:] != other[:-1]) | (other_th[1:] != other_th[:-1])
            begin = np.flatnonzero(pair)
            end = np.append(begin[1:], n)
            open_ = (bound == UNBOUND) | (bound >= min_words)
            alone = end - begin == 1
            first = begin[alone & open_[begin]]  # chains of one anchor
            last, anchors = first, [np.array(z, "<i4").tobytes() for z in zip(pos[first].tolist(), other_pos[first].tolist())]
            more_first, more_last = [], []
            for a, b in zip(begin[~alone].tolist(), end[~alone].tolist()):
                x, y = pos[a:b].astype(np.int64), other_pos[a:b].astype(np.int64)
                for chain in chain_anchors(x, y):
                    if len(chain) > 1 or open_[a + chain[0]]:
                        more_first.append(a + chain[0])
                        more_last.append(a + chain[-1])
                        anchors.append(np.concatenate([x[chain], y[chain]]).astype("<i4").tobytes())
            first = np.concatenate([first, np.array(more_first, np.int64)])
            last = np.concatenate([last, np.array(more_last, np.int64)])
            if len(first):
                columns = (doc[first], th[first], other[first], other_th[first], pos[first], pos[last] + np.int32(K),
                           other_pos[first], other_pos[last] + np.int32(K),
                           (place[first] - low[stretch[first]]).astype(np.int32),
                           (high[stretch[last]] - place[last] - K).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(anchors, pa.binary())],
                                                 names=[c.split()[0] for c in CHAIN_SCHEMA.split(", ")])
    return run


def _binary(column: pa.ChunkedArray) -> tuple[list[int], pa.Buffer]:
    """Offsets and bytes of a binary column."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    _, offset, raw = array.buffers()
    offset = np.frombuffer(offset, np.int32)[array.offset:array.offset + len(array) + 1]
    return offset.tolist(), raw


def _align(min_words: int, min_identity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, begin, end in whole_groups(batches, 1):
            side, tile, start = (cols[i].to_numpy() for i in (1, 2, 3))
            offset, raw = _binary(cols[4])
            rows, heads = [], []
            for a, b in zip(begin.tolist(), end.tolist()):
                if side[a] != 0:
                    continue
                anchors = np.frombuffer(raw, "<i4", (offset[a + 1] - offset[a]) // 4, offset[a]).astype(np.int64)
                x, y = anchors[:len(anchors) // 2], anchors[len(anchors) // 2:]
                words, base = [], []
                for s in (1, 2):  # rows in a row are bytes in a row
                    p, q = a + np.searchsorted(side[a:b], [s, s + 1])
                    n = (offset[q] - offset[p]) // 4
                    words.append(np.frombuffer(raw, "<u4", n, offset[p]) if n else np.zeros(0, np.uint32))
                    base.append(int(start[p]) if q > p else 0)
                found = align_chain(words[0], words[1], x - base[0], y - base[1], min_words, min_identity)
                # All that was asked for is there (a text that ends gives less), and a passage reaches its border.
                to = int(tile[a]) - base[0], int(start[a]) - base[1]
                more = any(p == 0 < base[0] or u == 0 < base[1] or q == to[0] or v == to[1] for p, q, u, v, *_ in found)
                for p, q, u, v, equal, same in found:
                    n, identity = min(q - p, v - u), equal / max(q - p, v - u)
                    rows.append((p + base[0], q + base[0], u + base[1], v + base[1], n, min(equal, n), min(identity, 1.0),
                                 False, more))
                    rows += [(e + base[0], f + base[0], u + base[1], None, None, None, None, True, more) for e, f in same]
                    heads += [a] * (1 + len(same))
            if rows:
                names = [c.take(pa.array(heads)).combine_chunks() for c in [*cols[5:8], cols[0]]]
                yield pa.RecordBatch.from_arrays(
                    [*(c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in names),
                     *(pa.array(c, t) for c, t in zip(zip(*rows), _ALIGNED))], names=[*("doc_id", "th", "other_id", "chain"), *_ALIGNED_NAMES])
    return run


_ALIGNED_NAMES = ("begin", "end", "other_begin", "other_end", "n_words", "n_equal", "identity", "run", "more")
_ALIGNED = (*[pa.int32()] * 6, pa.float64(), pa.bool_(), pa.bool_())
ALIGNED_SCHEMA = ("doc_id long, th int, other_id long, chain long, begin int, end int, other_begin int, other_end int, "
                  "n_words int, n_equal int, identity double, run boolean, more boolean")

#: Documents in which common seeds are looked for: one of so many, by a hash.
SAMPLE = 32
#: Slots by which later rounds leave out documents that no chain asks for.
SLOTS = 1 << 20
#: A seed of so many documents of the sample is dealt to buckets of about BUCKET documents.
COMMON = 128
BUCKET = 2048


def _place(bounds: Column, key: Column) -> Column:
    """How many of the ascending ``bounds`` are not above ``key``, by halving."""
    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s.low + s.high) / 2).cast("int")
        above = F.get(bounds, middle) > key
        return F.struct(F.when((s.low < s.high) & ~above, middle + 1).otherwise(s.low).alias("low"),
                        F.when((s.low < s.high) & above, middle).otherwise(s.high).alias("high"))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high")), halve, lambda s: s.low)


def _dealt(seeds: DataFrame, scratch: Scratch) -> DataFrame:
    """Seeds with ``bucket`` and ``own``. The bucket is 0, or for seeds that very many documents have one of some ranges of
    documents; such a bucket also has rows that are not its own, of the documents before to which it is linked."""
    columns = ("seed", "bucket", "doc_id", "th", "pos", "before", "after")
    sample = seeds.where(F.pmod(F.xxhash64("doc_id", "th"), F.lit(SAMPLE)) == 0).select("seed", "doc_id", "th")
    common = sample.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).select(F.col("seed").alias("common"))
    nth = F.row_number().over(Window.partitionBy("seed").orderBy("doc_id", "th"))
    bounds = sample.join(common, F.col("seed") == F.col("common")).withColumn("nth", nth) \
        .where(F.col("nth") % max(1, BUCKET // SAMPLE) == 0) \
        .groupBy("common").agg(F.array_sort(F.collect_set(F.struct("doc_id", "th"))).alias("bounds"))
    bounds = scratch.table(bounds, "common")
    if bounds.isEmpty():
        return seeds.withColumn("bucket", F.lit(0)).withColumn("own", F.lit(True)).select(*columns, "own")
    # A bound for BUCKET rows of the seeds: few enough that the seeds are not shuffled for them.
    bounds = F.broadcast(bounds)
    place = F.when(F.col("bounds").isNull(), 0).otherwise(_place(F.col("bounds"), F.struct("doc_id", "th")))
    dealt = seeds.join(bounds, F.col("seed") == F.col("common"), "left").withColumn("bucket", place).select(*columns)
    hot = seeds.join(bounds, F.col("seed") == F.col("common")).withColumn("bucket", place).select(*columns)
    edges = hot.repartition("seed", "bucket").sortWithinPartitions("seed", "bucket", "doc_id", "th", "pos") \
        .mapInArrow(tidy(_edges), EDGE_SCHEMA)
    words = ("seed", "kind", "x", "y")
    carried = edges.repartition(*words).sortWithinPartitions(*words, "bucket", "doc_id", "th", "pos") \
        .mapInArrow(tidy(_carried), SEEN_SCHEMA)
    return dealt.withColumn("own", F.lit(True)).unionByName(carried.withColumn("own", F.lit(False)))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY) -> DataFrame:
    """(doc_id, other_id, begin, end, other_begin, other_end, n_words, n_equal, identity).

    Positions are word numbers, ends exclusive; ``other_id`` is not after ``doc_id``.
    """
    spark = ready(docs.sparkSession)
    scratch = Scratch(spark, "passages")
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("th"), "text")
    seeds = scratch.table(texts.mapInArrow(tidy(_seeds(min_words)), SEED_SCHEMA), "seeds")
    order = ("seed", "bucket", "doc_id", "th", "pos")
    links = _dealt(seeds, scratch).repartition("seed", "bucket").sortWithinPartitions(*order).mapInArrow(tidy(_links), LINK_SCHEMA)
    # A task has all links of a document: their number is bounded by its own seeds.
    chains = links.repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "other_id", "other_th", "pos", "other_pos") \
        .mapInArrow(tidy(_chains(min_words)), CHAIN_SCHEMA)
    chains = scratch.table(chains.withColumn("chain", F.monotonically_increasing_id()), "chains")
    scratch.drop(seeds)

    found = _in_rounds(chains, texts, scratch, min_words, min_identity)
    # A passage inside a run of equal words of another row says nothing new; a document has a bounded number of them.
    place = Window.partitionBy("doc_id", "th").orderBy("begin", F.col("end").desc(), "other_id", "other_begin", "run", "other_end",
                                                      F.desc("n_equal"))
    reach = F.max(F.when(F.col("run"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    row = F.struct("begin", "end", "other_id", "other_begin", "other_end", "run")  # two chains of a pair may find one passage
    return found.withColumn("reach", reach).withColumn("before", F.lag(row).over(place)).withColumn("row", row) \
        .where(~F.col("run") & (F.col("reach").isNull() | (F.col("reach") < F.col("end"))) & ~F.col("before").eqNullSafe(F.col("row"))) \
        .drop("reach", "before", "row", "run", "th", "chain", "more")


def _in_rounds(chains: DataFrame, texts: DataFrame, scratch: Scratch, min_words: int, min_identity: float) -> DataFrame:
    """Passages of the chains. Those that reach the border of what was fetched are aligned again with more words."""
    rounds, margin, again = [], MARGIN, False
    while True:
        aligned = scratch.table(_aligned(chains, texts, margin, min_words, min_identity, again), "aligned")
        rounds.append(aligned.where("NOT more"))
        more = aligned.where("more").select("chain").distinct()
        if more.isEmpty():
            return functools.reduce(DataFrame.unionByName, rounds)
        chains, margin, again = scratch.table(chains.join(more, "chain", "left_semi"), "more"), 4 * margin, True


def _aligned(chains: DataFrame, texts: DataFrame, margin: int, min_words: int, min_identity: float, again: bool) -> DataFrame:
    """Passages of the chains within ``margin`` words of their links; ``more`` where one may go on beyond.

    ``again``: the chains are what earlier rounds left, of few documents: only these are cut into tiles.
    """

    def wanted(side: int, doc: str, th: str, begin: str, end: str) -> DataFrame:
        # A passage may go on where the document has links with others. A quarter more: the other side may have words
        # that this one lacks.
        low = F.col(begin) - margin - F.ceil(F.col("back") * 1.25)
        return chains.select("chain", F.lit(side).alias("side"), F.col(doc).alias("wanted_id"), F.col(th).alias("wanted_th"),
                             F.greatest(low, F.lit(0)).cast("int").alias("low"), last(end).alias("high"))

    def last(end: str):
        return (F.col(end) + margin + F.ceil(F.col("ahead") * 1.25)).cast("int")

    need = wanted(1, "doc_id", "th", "x0", "x1").unionByName(wanted(2, "other_id", "other_th", "y0", "y1"))
    need = need.withColumn("tile", F.explode(F.sequence(
        F.floor(F.col("low") / TILE).cast("int"), F.floor((F.col("high") - 1) / TILE).cast("int"))))
    if again:  # at most SLOTS rows are broadcast, and no text is shuffled to be left out
        slot = lambda doc, th: F.pmod(F.xxhash64(doc, th), F.lit(SLOTS))
        slots = need.select(slot("wanted_id", "wanted_th").alias("slot")).distinct()
        texts = texts.withColumn("slot", slot("doc_id", "th")).join(F.broadcast(slots), "slot", "left_semi").drop("slot")
    tiles = texts.mapInArrow(tidy(_tiles(min_words)), "doc_id long, th int, number int, words binary") \
        .dropDuplicates(["doc_id", "th", "number"])  # a row that is there again is the same document
    first = F.greatest(F.col("low") - F.col("tile") * TILE, F.lit(0))
    count = F.least(F.col("high") - F.col("tile") * TILE, F.lit(TILE)) - first
    names = ("doc_id", "th", "other_id")
    cuts = need.join(tiles, (F.col("wanted_id") == F.col("doc_id")) & (F.col("wanted_th") == F.col("th"))
                     & (F.col("tile") == F.col("number"))).select(
        "chain", "side", "tile", (F.col("tile") * TILE + first).cast("int").alias("start"),
        F.substring("words", first * 4 + 1, count * 4).alias("data"),
        *(F.lit(None).cast(dict(chains.dtypes)[c]).alias(c) for c in names))
    # A chain's own row carries the ends of both ranges.
    heads = chains.select("chain", F.lit(0).alias("side"), last("x1").alias("tile"), last("y1").alias("start"),
                          F.col("anchors").alias("data"), *names)
    return heads.unionByName(cuts).repartition("chain").sortWithinPartitions("chain", "side", "tile") \
        .mapInArrow(tidy(_align(min_words, min_identity)), ALIGNED_SCHEMA)
