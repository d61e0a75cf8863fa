"""Language identification with a linear-chain conditional random field.

Every word of a text gets a distribution over languages from forward-backward,
so code-switched text is labelled word by word; a document's language is the
one with the largest share of its words, the score that share.

A word's features are its byte n-grams of two to four bytes, with a mark at the
word's start and end (so the first and last are its affixes), and the whole
word (the lexicon), all hashed into ``BUCKETS`` rows of one weight for each
language. Transitions between the languages of neighbouring words are learned.
A chain is a line of text; a longer line is cut into chains of ``CHAIN_WORDS``.
All words of a text are labelled, whatever its length.

``keep_recognised`` names the language of each text in ``lang`` and drops texts of none. Whether a
text is of any learned language at all can't be read from shares among those
languages, so it asks for evidence: the share of the text's
four-byte n-grams (with edge marks) that two training documents have. A text stays with
at least half of the median share of the training documents, however many languages
there are; short texts are drawn towards that median (``PRIOR`` n-grams).

Training maximises the conditional likelihood on a bounded, documented sample:
``per_lang`` documents of each language by a hash of ``doc_id``, of which
pieces of different languages are joined into code-switched chains. It
runs in one task; labelling maps over all documents and shuffles nothing.

Defined cases: null text and text without a letter are ``und`` with score 0;
null languages are not learned; without any language every text is ``und``;
equal texts are labelled alike; ties go to the language first by code point;
other columns are ignored (``keep_recognised`` keeps them, and ``lang`` gets the language found); a text without any n-gram of
four bytes (single letters) has no evidence against it and stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_bytes, crc_mod, mix64, ready, slices, tidy
from shopstream.llm.training import fit_in_one_task, sample_by_class, training_rows

BUCKETS = 1 << 16
CHAIN_WORDS = 64
PER_LANG = 1200
PIECES = 3
EPOCHS = 4
RATE = 0.25
DECAY = 1e-5
HELD_MOD, HELD = 3, 1
UNKNOWN = "und"
#: Text labelled at a time in a task.
LABEL_BYTES = 1 << 20
#: Bits of the set of n-grams that two training documents have.
SEEN_BITS = 1 << 22
#: N-grams of the median share that are added to each text's own, and the part of that share that is asked for.
PRIOR, PART = 8, 0.5

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_rng = np.random.Generator(np.random.PCG64(20240601))
_PLACE = _rng.integers(0, 1 << 63, size=(32, 256), dtype=np.uint64)


def lower(texts: list[bytes | None]) -> list[bytes]:
    return [(t or b"").decode().lower().encode() for t in texts]


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case texts as one byte array; start and end of each word, its text and its chain number.

    A new chain begins with a text, after a line break and after CHAIN_WORDS words.
    """
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    letter = _LETTER[data]
    edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, start, side="right")
    line = np.cumsum(data == 10)[start] if len(start) else np.zeros(0, np.int64)
    new = np.ones(len(start), bool)
    new[1:] = line[1:] != line[:-1]
    first = np.flatnonzero(new)
    inside = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
    chain = np.cumsum(new | (inside % CHAIN_WORDS == 0)) - 1
    return data, start, end, doc, chain


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    place = at - np.repeat(start, size)
    return mix64(np.add.reduceat(mix64(_PLACE[place & 31, data[at]] + place.astype(np.uint64)), np.cumsum(size) - size))


def _marked(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words in a row with a mark (0) on either side, and for each its word and the bytes left in it."""
    size = end - start + 2
    base = np.cumsum(size) - size
    marked = np.zeros(int(size.sum()) + 4, np.uint32)
    at = np.repeat(start - np.cumsum(size - 2) + size - 2, size - 2) + np.arange((size - 2).sum())
    to = np.repeat(base + 1 - np.cumsum(size - 2) + size - 2, size - 2) + np.arange((size - 2).sum())
    marked[to] = data[at]
    word = np.repeat(np.arange(len(start)), size)
    return marked, word, np.repeat(base + size, size) - np.arange(len(word))


def four_grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, number below SEEN_BITS) of every four bytes in a row of marked words."""
    marked, word, left = _marked(data, start, end)
    at = np.flatnonzero(left >= 4)
    x = marked[at] | marked[at + 1] << np.uint32(8) | marked[at + 2] << np.uint32(16) | marked[at + 3] << np.uint32(24)
    return word[at], (mix64(x.astype(np.uint64)) >> np.uint64(42)).astype(np.int64)


def seen_grams(texts: list[bytes]) -> np.ndarray:
    """For each n-gram number whether two of the (lower-case) texts have it."""
    count = np.zeros(SEEN_BITS, np.uint8)
    for text in texts:
        data, start, end, _, _ = split_words([text])
        gram = np.unique(four_grams(data, start, end)[1])
        count[gram] = np.minimum(count[gram], 1) + 1
    return count >= 2


def evidence(texts: list[bytes], seen: np.ndarray, median: float) -> np.ndarray:
    """Share of each text's n-grams that are seen, with PRIOR n-grams of the median share added."""
    data, start, end, doc, _ = split_words(texts)
    known, total = np.zeros(len(texts)), np.zeros(len(texts))
    if len(start):
        _, first, which = np.unique(word_hashes(data, start, end), return_index=True, return_inverse=True)
        word, gram = four_grams(data, start[first], end[first])  # equal words are looked up once
        n, k = np.bincount(word, minlength=len(first)), np.bincount(word, weights=seen[gram], minlength=len(first))
        total = np.bincount(doc, weights=n[which.ravel()], minlength=len(texts))
        known = np.bincount(doc, weights=k[which.ravel()], minlength=len(texts))
    return (known + PRIOR * median) / (total + PRIOR)


def median_share(texts: list[bytes], seen: np.ndarray) -> float:
    share = [(len(g) and seen[g].mean()) for g in (four_grams(*split_words([t])[:3])[1] for t in texts) if len(g)]
    return float(np.median(share)) if share else 0.0


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature: n-grams with edge marks and the word itself."""
    n = len(start)
    marked, word, left = _marked(data, start, end)
    words, buckets = [np.arange(n)], [(lexicon >> np.uint64(48)).astype(np.int64)]
    h = marked[:len(word)] + np.uint32(0x51ED)
    for k in (2, 3, 4):
        h = h * np.uint32(0x01000193) + marked[k - 1:k - 1 + len(word)] + np.uint32(k)
        ok = left >= k
        x = h[ok]
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        words.append(word[ok])
        buckets.append(((x ^ (x >> np.uint32(13))) >> np.uint32(16)).astype(np.int64))
    return np.concatenate(words), np.concatenate(buckets)


def emissions(weights: np.ndarray, data, start, end) -> np.ndarray:
    """Each word's score for each language; equal words are scored once."""
    h = word_hashes(data, start, end)
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    word, bucket = word_features(data, start[first], end[first], h[first])
    out = np.empty((len(first), weights.shape[1]))
    for k in range(weights.shape[1]):
        out[:, k] = np.bincount(word, weights=weights[bucket, k], minlength=len(first))
    return out[which.ravel()]


def forward_backward(score: np.ndarray, chain: np.ndarray, trans: np.ndarray, init: np.ndarray,
                     pairs: bool = False):
    """Marginals of each word, the log-likelihood's normaliser of all chains and, if asked,
    the expected number of each transition.

    All chains step together: word t of every chain that has one.
    """
    n, k = score.shape
    first = np.flatnonzero(np.diff(chain, prepend=-1))
    size = np.diff(np.append(first, n))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    high = score.max(axis=1, keepdims=True)
    e = np.exp(score - high)
    a = np.exp(trans)
    alpha, beta = np.empty((n, k)), np.ones((n, k))
    norm = np.empty(n)
    longest = int(size.max(initial=0))
    live = np.searchsorted(-size, -np.arange(longest), side="left")  # chains with a word t
    for t in range(longest):
        i = first[:live[t]] + t
        x = (np.exp(init) if t == 0 else alpha[i - 1] @ a) * e[i]
        norm[i] = s = x.sum(axis=1)
        alpha[i] = x / s[:, None]
    expected = np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        i = first[:live[t]] + t
        x = beta[i] * e[i] / norm[i][:, None]
        if pairs:
            expected += a * (alpha[i - 1].T @ x)
        beta[i - 1] = x @ a.T
    return alpha * beta, float(np.log(norm).sum() + high.sum()), expected


def fit_crf(texts: list[bytes], langs: np.ndarray, n_langs: int, epochs: int = EPOCHS, seed: int = 3
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature weights, transitions and start scores by AdaGrad on code-switched chains."""
    rng = np.random.Generator(np.random.PCG64(seed))
    # Pieces of up to 20 words from random places of each document; only their bytes are kept.
    kept, pieces, n_kept = [], [], 0
    for text, lang in zip(texts, langs):
        data, start, end, _, _ = split_words([text])
        n = len(start)
        for _ in range(PIECES if n else 0):
            size = min(int(rng.integers(4, 21)), n)
            at = int(rng.integers(0, n - size + 1))
            kept.append(b" ".join(data[a:b].tobytes() for a, b in zip(start[at:at + size], end[at:at + size])))
            pieces.append((n_kept, size, lang))
            n_kept += size
    data, start, end, _, _ = split_words([b" ".join(kept)])
    w, tr, st = np.zeros((BUCKETS, n_langs)), np.zeros((n_langs, n_langs)), np.zeros(n_langs)
    g_w, g_tr, g_st = np.full_like(w, 1e-3), np.full_like(tr, 1e-3), np.full_like(st, 1e-3)
    h = word_hashes(data, start, end)
    for _ in range(epochs):
        turn = rng.permutation(len(pieces))
        for b in range(0, len(turn), 256):
            part = [pieces[i] for i in turn[b:b + 256]]
            words = np.concatenate([np.arange(at, at + size) for at, size, _ in part])
            label = np.concatenate([np.full(size, y) for _, size, y in part])
            # Two or three pieces make a chain.
            joins = np.cumsum(rng.random(len(part)) < 0.45)
            chain = np.unique(np.repeat(joins, [size for _, size, _ in part]), return_inverse=True)[1].ravel()
            word, bucket = word_features(data, start[words], end[words], h[words])
            used, at = np.unique(bucket, return_inverse=True)
            at = at.ravel()
            score = np.zeros((len(words), n_langs))
            for k in range(n_langs):
                score[:, k] = np.bincount(word, weights=w[bucket, k], minlength=len(words))
            marginal, _, expected = forward_backward(score, chain, tr, st, pairs=True)
            marginal[np.arange(len(words)), label] -= 1.0  # expected minus observed
            grad = np.zeros((len(used), n_langs))
            for k in range(n_langs):
                grad[:, k] = np.bincount(at, weights=marginal[word, k], minlength=len(used))
            grad = grad / len(part) + DECAY * w[used]
            g_w[used] += grad * grad
            w[used] -= RATE * grad / np.sqrt(g_w[used])
            inner = np.flatnonzero(chain[1:] == chain[:-1])
            np.add.at(expected, (label[inner], label[inner + 1]), -1.0)
            expected = expected / len(part) + DECAY * tr
            g_tr += expected * expected
            tr -= RATE * expected / np.sqrt(g_tr)
            head = np.flatnonzero(np.diff(chain, prepend=-1))
            d_st = marginal[head].sum(axis=0) / len(part)
            g_st += d_st * d_st
            st -= RATE * d_st / np.sqrt(g_st)
    return w, tr, st


def train(docs: DataFrame, per_lang: int = PER_LANG) -> dict | None:
    """The model from ``docs``' own languages; None without any."""
    ready(docs.sparkSession)
    rows = training_rows(docs.select("doc_id", "text", "lang"), HELD_MOD, HELD)
    sample = sample_by_class(rows.select("doc_id", F.col("lang").alias("label")), rows.select("doc_id", "text"), per_lang)
    sample = sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")

    def fit(table: pa.Table) -> pa.RecordBatch:
        ids = np.array(table["doc_id"].to_pylist())
        table = table.take(pa.array(np.argsort(ids, kind="stable")))
        names = sorted(set(table["label"].to_pylist()), key=lambda s: s.encode())
        langs = np.array([names.index(x) for x in table["label"].to_pylist()])
        texts = [t for c in table["text"].chunks for t in lower(as_bytes(c))]
        w, tr, st = fit_crf(texts, langs, len(names))
        seen = seen_grams(texts)
        return pa.RecordBatch.from_arrays([
            pa.array([names]), *(pa.array([x.astype("<f4").tobytes()]) for x in (w, tr, st)),
            pa.array([np.packbits(seen).tobytes()]), pa.array([median_share(texts, seen)])],
            names=["langs", "w", "tr", "st", "seen", "median"])

    got = fit_in_one_task(sample, fit, "langs array<string>, w binary, tr binary, st binary, seen binary, median double").collect()
    if not got:
        return None
    k = len(got[0].langs)
    f = lambda b, shape: np.frombuffer(b, "<f4").reshape(shape)
    return {"langs": list(got[0].langs), "w": f(got[0].w, (BUCKETS, k)), "tr": f(got[0].tr, (k, k)).astype(float),
            "st": f(got[0].st, (k,)).astype(float), "seen": np.unpackbits(np.frombuffer(got[0].seen, np.uint8)).astype(bool),
            "median": got[0].median}


def label_words(texts: list[bytes], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Each word's text number and its distribution over the model's languages (texts in lower case)."""
    data, start, end, doc, chain = split_words(texts)
    score = emissions(model["w"], data, start, end)
    return doc, forward_backward(score, chain, model["tr"], model["st"])[0]


def _document_languages(texts: list[bytes], lettered: list[bool], model: dict | None) -> tuple[list[str], np.ndarray]:
    n = len(texts)
    if model is None:
        return [UNKNOWN] * n, np.zeros(n)
    doc, marginal = label_words(texts, model)
    share = np.stack([np.bincount(doc, weights=marginal[:, k], minlength=n) for k in range(marginal.shape[1])], axis=1)
    share = share / np.maximum(share.sum(axis=1, keepdims=True), 1e-12)
    best = share.argmax(axis=1)
    known = np.array(lettered, bool)
    score = np.where(known, np.minimum(share[np.arange(n), best], 1.0), 0.0)
    return [model["langs"][b] if k else UNKNOWN for b, k in zip(best, known)], score


def _broadcast(spark, model):
    return spark.sparkContext.broadcast(model)  # BUCKETS rows of a weight for each language, SEEN_BITS truth values


def detect(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score)."""
    spark = ready(docs.sparkSession)
    shared = _broadcast(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", LABEL_BYTES):
                lang, score = _document_languages(lower(as_bytes(part.column("text"))),
                                                  part.column("lettered").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (crc_mod(F.col("doc_id"), HELD_MOD) == HELD).alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_recognised(docs: DataFrame, model: dict | None, part_of_median: float = PART) -> DataFrame:
    """``docs`` with the language of each text in ``lang``, as ``detect`` has it, without those of no language (``und``)
    and those whose n-grams are not of the learned languages.

    Without a model (no language was given to learn from) only texts without a letter go, and no language is named.
    """
    spark = ready(docs.sparkSession)
    shared = _broadcast(spark, model)
    cols = docs.columns
    lettered = _free_name(cols, "lettered")
    named = next((i for i, c in enumerate(cols) if c.lower() == "lang"), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", LABEL_BYTES):
                ok = np.array(part.column(lettered).to_pylist(), bool)
                if shared.value is None:
                    yield part.filter(pa.array(ok)).select(cols)
                    continue
                texts = lower(as_bytes(part.column("text")))
                median = shared.value["median"]
                ok &= evidence(texts, shared.value["seen"], median) >= part_of_median * median
                part = part.filter(pa.array(ok)).select(cols)
                if part.num_rows and named is not None:
                    lang, _ = _document_languages([t for t, k in zip(texts, ok) if k], [True] * part.num_rows, shared.value)
                    part = part.set_column(named, part.schema.field(named), pa.array(lang, part.schema.field(named).type))
                yield part

    rows = docs.select("*", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(lettered))
    return rows.mapInArrow(tidy(run), docs.schema)


def _free_name(taken: list[str], name: str) -> str:
    low = {c.lower() for c in taken}
    while name in low:
        name += "_"
    return name
