from __future__ import annotations

import hashlib
from collections import defaultdict

from shopstream.llm import mixing
from shopstream.llm.queries import LLM_QUERIES


def _level(sizes, weights=mixing.WEIGHTS, most=3):
    """Targets by plain resharing, round after round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free} if free else {}
        over = [s for s in free if share[s] >= most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def test_targets_and_taken_words(sample_docs):
    rows = mixing.taken_words(sample_docs).join(sample_docs.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, biggest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    want = _level(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s]


def test_reruns_and_partitions_agree(sample_docs):
    a = sorted(tuple(r) for r in mixing.taken_words(sample_docs).collect())
    b = sorted(tuple(r) for r in mixing.taken_words(sample_docs.repartition(7)).collect())
    assert a == b


def test_edge_rows(make_docs):
    rows = [(1, None, "en", "b"), (2, "", "en", "b"), (3, "one two three", None, None), (4, "w " * 9000, "en", "a"),
            (5, "x y", "en", "a"), (5, "x y", "en", "a"), (None, "no id here", "en", "c")]
    got = {(r.doc_id, r.size): r for r in mixing.taken_words(make_docs(rows)).collect()}
    assert got[1, 0].source_size == 0 and got[1, 0].target == 0 and got[1, 0].taken == 0
    assert got[3, 3].source_size == 3 and got[3, 3].taken <= 9
    assert mixing.taken_words(make_docs(rows)).count() == len(rows)
    assert mixing.taken_words(make_docs([])).collect() == []


def test_hot_source_is_cut_into_buckets(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('w ', repeat('x ', cast(id % 7 AS int))) AS text",
                                          "if(id % 3 = 0, 'hot', concat('s', id % 50)) AS source")
    rows, plan = mixing.mixing_plan(docs, bucket_rows=500)
    hot = plan.where("source = 'hot'").first()
    words = rows.where("source = 'hot'").where(f"h < '{hot.boundary}'").groupBy().sum("size").first()[0]
    rest = hot.target - hot.passes * hot.source_size
    assert abs(words - rest) <= 8


def test_mix_repeats_rows_in_training_order(make_docs):
    rows = [(i, "w " * (i % 5 + 1), "en", "abc"[i % 3]) for i in range(300)]
    docs = make_docs(rows)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.taken_words(docs).collect()}
    seen = defaultdict(int)
    for r in mixed.collect():
        seen[r.doc_id] += 1
    assert {k: v for k, v in copies.items() if v} == dict(seen)


def test_schedules_move_sources_through_training(make_docs):
    # Source a grows over time (0.5 to 1.5), c shrinks (1.5 to 0.5).
    docs = make_docs([(i, "w w w", "en", "abc"[i % 3]) for i in range(3000)])
    order = [r.source for r in mixing.mix_documents(docs).select("source").collect()]
    half = len(order) // 2
    share = lambda s: order[:half].count(s) / max(1, order.count(s))
    a, c = (lambda u: (u + u * u) / 2), (lambda u: (3 * u - u * u) / 2)
    # Half of the demand is met at the time u where 5 a(u) + 2 u + c(u) = 4.
    u = min((i / 1000 for i in range(1001)), key=lambda x: abs(5 * a(x) + 2 * x + c(x) - 4))
    assert abs(share("a") - a(u)) < 0.05 and abs(share("c") - c(u)) < 0.05 and a(u) < u < c(u)


def test_position_inverts_the_schedule(spark):
    df = spark.range(1).select(*[mixing.training_position(mixing.F.lit(s), mixing.F.lit(0), [(0.5, 1.5)]).alias(f"p{i}")
                                 for i, s in enumerate((0.0, 0.375, 1.0))]).first()
    assert abs(df.p0) < 1e-12 and abs(df.p1 - 0.5) < 1e-12 and abs(df.p2 - 1.0) < 1e-12


def test_positions_follow_the_words_before(make_docs):
    # Documents of 1 to 10,000 words: a place by hash is not a place by words.
    rows = [(i, "w " * (10_000 if i % 40 == 0 else i % 9 + 1), "en", "abc"[i % 3]) for i in range(400)]
    rows += [(7, "w w w w", "en", "b"), (500, None, "en", "a"), (501, "x", None, None)]
    got = defaultdict(list)
    for r in mixing.training_positions(make_docs(rows), bucket_rows=20).collect():
        got[r.source].append(r)
    names = ["a", "b", "c", None]
    want = _level({s: sum(r.size for r in got[s]) for s in names})
    for rank, s in enumerate(names):
        a, b = mixing.SCHEDULES[rank % 3]
        size, target = sum(r.size for r in got[s]), want[s]
        docs = sorted(got[s], key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.size))
        before, middle = 0, {}
        for r in docs:
            middle[r.doc_id] = before + r.size / 2  # of rows with one id the last
            before += r.size
        for r in docs:
            words = [k * size + middle[r.doc_id] for k in range(3)]
            words = [w for k, w in enumerate(words) if w < target or (k + 1) * size <= target]
            assert len(r.positions) == len(words)
            for u, w in zip(r.positions, words):  # the demand met by then is the words before
                assert abs((a * u + (b - a) * u * u / 2) / ((a + b) / 2) * target - min(w, target)) < 1e-6 * target


def test_taken_words_come_from_positions(make_docs):
    docs = make_docs([(i, "w " * (i % 11), "en", "abcd"[i % 4]) for i in range(500)])
    copies = {r.doc_id: len(r.positions) for r in mixing.training_positions(docs).collect()}
    assert {r.doc_id: r.copies for r in mixing.taken_words(docs).collect()} == copies
    plan = mixing.taken_words(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "SQRT" in plan.upper()  # the inverse of the demand is on the way to the result
    order = [r.doc_id for r in mixing.mix_documents(docs).collect()]
    when = sorted((p, hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id)
                  for r in mixing.training_positions(docs).collect() for p in r.positions)
    assert order == [w[2] for w in when]


def test_the_query_counts_in_the_mix(spark, make_docs, tmp_path, monkeypatch):
    """op2_mixing makes the whole mix, texts in training order, and counts its rows."""
    rows = [(i, "w " * (i % 11), "en", "abcd"[i % 4]) for i in range(300)]
    rows += [(7, "w w w w", "en", "b"), (7, "v v v v", "en", "b"), (500, None, "en", "a"), (501, "x", None, None), (None, "y z", "en", "c"),
             (None, "y z", "en", "c"), (600, "", "en", "none")]
    docs = make_docs(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    made = {}
    table = mixing.Scratch.table

    def kept(self, df, name, *a, **b):
        made[name] = table(self, df, name, *a, **b)
        return made[name]
    monkeypatch.setattr(mixing.Scratch, "table", kept)
    got = [tuple(r) for r in LLM_QUERIES["op2_mixing"](spark, str(tmp_path)).collect()]
    monkeypatch.undo()
    # The mix has every column of the documents, copies by position.
    assert made["mix"].columns == docs.columns
    order = [(r.doc_id, r.source) for r in made["mix"].collect()]
    assert [r[0] for r in order] == [r.doc_id for r in mixing.mix_documents(docs).collect()]
    n_rows, n_mix = defaultdict(int), defaultdict(int)
    for i, _, _, source in rows:
        n_rows[i, source] += 1
    for key in order:
        n_mix[key] += 1
    assert sum(n_mix.values()) == sum(r[5] for r in got) and len(got) == len(rows)
    assert sorted(got, key=str) == sorted((tuple(r) for r in mixing.taken_words(docs).collect()), key=str)
    for i, _, _, source in rows:
        assert n_mix[i, source] % n_rows[i, source] == 0
