from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import components, jaccard, queries


def _sets(rows, size=3):
    out = {}
    for i, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [tuple(found[k : k + size]) for k in range(len(found) - size + 1)] if len(found) >= size else [tuple(found)] if found else []
        out[i] = frozenset(grams)
    return out


def _brute(rows, size=3, percent=90):
    sets = _sets(rows, size)
    root, links = {i: i for i in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), links[i]) for i in ids}


def _near(prose, seed):
    """Groups around the threshold, of sizes from a few words to hundreds, with chains."""
    rng, rows = random.Random(seed), []
    for size in (3, 4, 8, 12, 20, 21, 40, 70, 150, 300):
        base = prose(seed * 1000 + size, size)
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, max(1, size // 60), max(1, size // 30)))):
                at, what = rng.randrange(len(copy)), rng.random()
                copy[at : at + 1] = [] if what < 0.3 and len(copy) > 1 else [f"new{rng.randrange(99)}"] * (1 if what < 0.8 else 2)
            rows.append(" ".join(copy))
            base = copy if rng.random() < 0.5 else base
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_query_equals_brute_force(spark, docs_of, stored_tables, prose):
    rows = _near(prose, 1) + [(1000, None), (1001, ""), (1002, "One"), (1003, "one"), (1004, "one two"), (1005, "x " * 20000), (1006, "x  x x")]
    got = queries.op7_jaccard(spark, stored_tables(documents=docs_of(rows))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == _brute(rows)
    assert len({r["component_id"] for r in got}) < len(rows) - 20


def test_small_blocks_and_shuffled_members_give_the_same(spark, docs_of, stored_tables, prose, monkeypatch):
    rows = _near(prose, 2)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", -1)
    got = queries.op7_jaccard(spark, stored_tables(documents=docs_of(rows))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == _brute(rows)


def test_five_words_at_eighty_percent(spark, docs_of, prose):
    rows = _near(prose, 3)
    got = jaccard.classes(docs_of(rows), 5, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component"], r["n_links"]) for r in got} == _brute(rows, 5, 80)


def test_linked_sets_always_share_a_key():
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        for _ in range(300):
            n = int(rng.integers(4, 900))
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            drop, add = (int(rng.integers(0, max(1, n * (100 - percent) // 100) + 1)) for _ in "ab")
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)])
            common = n - drop
            if 100 * common >= percent * (n + b.size - common):
                assert np.intersect1d(jaccard.keys(np.sort(a), percent), jaccard.keys(np.sort(b), percent)).size or not (drop or add)


def test_unrelated_sets_share_no_key():
    rng = np.random.default_rng(9)
    for percent in (80, 90):
        for size in (20, 60, 150, 400, 800, 2000, 5000):
            found = [jaccard.keys(rng.integers(0, 1 << 63, size).astype(np.uint64), percent) for _ in range(60)]
            every = np.concatenate([np.unique(k) for k in found])
            assert np.unique(every).size == every.size, (percent, size)


def test_shared_shingles_are_counted_exactly(spark, docs_of, prose, monkeypatch):
    """Credits of packed parts equal a count of shingles over distinct sets, for any size of chunk and part."""
    texts = [" ".join(prose(i % 23, 30 + i % 7) + prose(500 + i, i % 40)) for i in range(120)] + ["", None, "one", "one", "two words"]
    sets = {jaccard.shingles(t, 3).tobytes(): jaccard.shingles(t, 3) for t in texts if jaccard.shingles(t, 3).size}
    df = Counter(int(x) for s in sets.values() for x in s)
    expected = sorted(sum(df[int(x)] > 1 for x in s) for s in sets.values())
    import pyarrow as pa

    for chunk, bits in ((1 << 30, 0), (300, 0), (300, 3), (2000, 12)):
        monkeypatch.setattr(jaccard, "PACKED", chunk)
        batches = [pa.record_batch([pa.array(texts[i : i + 50], pa.string())], ["text"]) for i in range(0, len(texts), 50)]
        credit = Counter()
        by_part = lambda packed, schema: iter([pa.RecordBatch.from_pylist(sorted(packed, key=lambda r: r["part"]), schema)])
        rows = [r for b in jaccard._scan_shared(3, bits, 4)(iter(batches)) for r in b.to_pylist()]
        rows = [r for b in jaccard._credit(4)(by_part(rows, jaccard._PACKED)) for r in b.to_pylist()]
        for out in jaccard._sum_credits(by_part(rows, jaccard._CREDITS)):
            credit.update(dict(zip(out.column("sid").to_pylist(), out.column("credit").to_pylist())))
        assert sorted(credit.values()) == [n for n in expected if n]


def test_passages_in_common_tie_nothing(spark, docs_of, prose):
    passage = prose(1, 60)
    rows = [(i, " ".join(prose(100 + i, 150) + passage + prose(900 + i, 90))) for i in range(40)]
    docs = docs_of(rows)
    found = jaccard.classes(docs, 5, 80).collect()
    assert all(r["component"] == r["doc_id"] and r["n_links"] == 0 for r in found)
    keyed = docs.select("text")
    sets = [jaccard.shingles(t, 5) for _, t in rows]
    s1 = [int(jaccard._mixed(s ^ jaccard._A).sum().view(np.int64)) for s in sets]
    nodes = spark.createDataFrame([(a, s.size) for a, s in zip(s1, sets)], "s1 bigint, n bigint")
    assert jaccard._may_link(keyed, nodes, 5, 80).count() == 0
    assert jaccard._may_link(keyed, nodes, 5, 15).count() == 40


def test_repeated_rows_equal_ids_and_null_ids(spark, docs_of, prose):
    text = " ".join(prose(5, 40))
    docs = docs_of([(3, text), (3, text), (2, text), (None, text), (None, "other words here now"), (None, "other words here now"), (7, None), (None, None)])
    rows = jaccard.classes(docs).collect()
    assert len(rows) == 8 and {r["component"] for r in rows if r["doc_id"] in (2, 3)} == {2}
    kept = jaccard.keep_one(docs).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept if r["text"]) == [("2", text), ("None", "other words here now")]
    assert sum(r["text"] is None for r in kept) == 2


def test_keep_one_keeps_columns_and_empty_table(spark, docs_of):
    docs = docs_of([(1, "a b c d"), (2, "a b c d"), (3, "")]).withColumnsRenamed({"lang": "node", "source": "component"})
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_keep_one_keeps_unlike_rows_of_one_id_and_all_empty_ones(spark, docs_of, prose):
    one, other, third = (" ".join(prose(i, 40)) for i in (1, 2, 3))
    docs = docs_of([(7, one), (7, other), (7, other), (3, other), (None, "  "), (None, ""), (None, None), (9, None), (9, None), (5, third), (6, third)])
    kept = sorted((str(r["doc_id"]), str(r["text"])) for r in jaccard.keep_one(docs).collect())
    assert kept == sorted([("7", one), ("7", other), ("3", other), ("None", "  "), ("None", ""), ("None", "None"), ("9", "None"), ("5", third)])


def test_keep_one_leaves_columns_of_any_name(spark, docs_of):
    docs = docs_of([(1, "a b c d"), (2, "a b c d"), (3, "x y z")]).selectExpr("*", "'x' as _a", "'y' as _b", "'z' as key_a", "1 as row", "2 as component")
    kept = jaccard.keep_one(docs).collect()
    assert sorted((r["doc_id"], r["_a"], r["_b"], r["key_a"], r["row"], r["component"]) for r in kept) == [(i, "x", "y", "z", 1, 2) for i in (1, 3)]


def test_components_equal_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1400)] + [(5, 5)]
    rng.shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)).collect()
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    tied = {x for e in edges if e[0] != e[1] for x in e}
    assert {r["node"]: r["component"] for r in found} == {x: find(x) for x in tied}


def test_an_id_with_several_sets_ties_their_classes(spark, docs_of, prose):
    """Document 5 has the text of 3 and that of 2, so 2, 3, 5 and what links with them are one class."""
    x, y, z = (" ".join(prose(seed, 40)) for seed in (71, 72, 73))
    rows = [(5, x), (5, y), (3, y), (2, x), (9, x + " more"), (7, z), (8, z), (7, None), (None, z), (4, None)]
    found = {(r["doc_id"], r["n_shingles"], r["component"]) for r in jaccard.classes(docs_of(rows)).collect()}
    assert found == {(5, 38, 2), (3, 38, 2), (2, 38, 2), (9, 39, 2), (7, 38, 7), (8, 38, 7), (7, 0, 7), (None, 38, 7), (4, 0, 4)}


def test_a_key_ties_its_nodes_across_chunks(monkeypatch):
    """Rows sorted by key: one key may fill several chunks, or lie in the last rows of one and the first of the next."""
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    rows = [(4, 7), (5, 10), (5, 11), (7, 13), (7, 12), (7, 15), (7, 14), (7, 16), (7, 17), (8, 1), (9, 2), (9, 3)]
    batches = [
        pa.record_batch([pa.array([k for k, _ in part]), pa.array([n for _, n in part]), pa.nulls(len(part), pa.int64())], ["key", "node", "other"])
        for part in (rows[i : i + 3] for i in range(0, len(rows), 3))
    ]
    tied = pa.Table.from_batches(jaccard._combine(iter(batches))).to_pylist()
    edges = [(r["node"], r["other"]) for r in tied if r["other"] is not None]
    node, root = components.forest(*(np.array(x) for x in zip(*edges)))
    assert dict(zip(node.tolist(), root.tolist())) == {11: 10, 13: 12, 14: 12, 15: 12, 16: 12, 17: 12, 3: 2}


def test_credits_take_few_bytes_a_shingle():
    """The pipeline's executors ran out of memory here: each shingle in hand was held several times over."""
    import tracemalloc

    rng, n = np.random.default_rng(1), 200_000
    sids = rng.integers(1, 1 << 60, 50)
    rest, owners = rng.integers(0, n // 2, n).astype(np.uint32), rng.integers(0, 51, n).astype(np.uint16)
    row = {"part": 0, "sids": sids.tobytes(), "owners": owners.tobytes(), "rest": rest.tobytes()}
    batch = pa.RecordBatch.from_pylist([row, row], jaccard._PACKED)
    tracemalloc.start()
    found = [r for b in jaccard._credit(1)(iter([batch])) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    of = {}
    for r, o in zip(rest.tolist(), owners.tolist()):
        of.setdefault(r, []).append(o)
    credit = dict.fromkeys(range(1, 51), 0)
    for held in of.values():
        if 0 in held or len(set(held)) > 1:
            for o in held:
                if o:
                    credit[o] += 2
    got = {s: c for r in found for s, c in zip(np.frombuffer(r["sids"], np.int64).tolist(), np.frombuffer(r["owners"], np.uint32).tolist())}
    assert got == {int(sids[o - 1]): c for o, c in credit.items() if c}
    assert peak < 40 * 2 * n


def test_sorted_shingles_are_compared_in_stretches(monkeypatch):
    """Equal shingles stay together, also where they fill more than a stretch."""
    monkeypatch.setattr(jaccard, "STRETCH", 4)
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 3, 3, 9, (1 << 32) - 1, (1 << 32) - 1, (1 << 32) - 1, (1 << 32) - 1, (1 << 32) - 1]
    held = np.array([k << 32 | i for i, k in enumerate(keys)], np.uint64)
    found = [(x >> np.uint64(32)).tolist() for x in jaccard._stretches(held)]
    assert sum(found, []) == keys and len(found) > 2
    assert all(a[-1] != b[0] for a, b in zip(found, found[1:]))
    assert list(jaccard._stretches(held[:0])) == []


def test_most_sets_are_settled_by_a_part_of_their_shingles(spark, docs_of, prose, monkeypatch):
    """At 6 GB the packed shingles took more disk than the stage may use: all of them were shuffled at once."""
    assert [jaccard._first_bits(p) for p in (15, 60, 80, 90, 100)] == [0, 0, 1, 2, 4]
    texts = [" ".join(prose(i, 300)) for i in range(40)]
    whole = [jaccard.shingles(t, 5) for t in texts]
    scan = lambda *a: [r for b in jaccard._scan_shared(5, 0, 4, *a)(iter([pa.record_batch([pa.array(texts)], ["text"])])) for r in b.to_pylist()]
    count = lambda rows: sum(len(r["rest"]) // 4 for r in rows if r["part"] >= 0)
    for bits in (1, 2, 4):
        early = sum(jaccard._early(x, bits) for x in whole)
        assert count(scan(bits)) == early < 1.3 * count(scan()) / (1 << bits)
        assert count(scan(bits, False)) == count(scan()) - early
    scanned = []
    monkeypatch.setattr(jaccard, "_credits", lambda texts, total, *a, f=jaccard._credits, **k: scanned.append(total) or f(texts, total, *a, **k))
    near = [(100 + i, " ".join(prose(7, 200) + [f"end{i}"])) for i in range(3)]
    found = {r["doc_id"]: r["component"] for r in jaccard.classes(docs_of([*enumerate(texts), *near]), 5, 80).collect()}
    assert found == {i: 100 if i >= 100 else i for i in found}
    assert sum(scanned) < 0.75 * sum(x.size for x in whole)


def test_shuffle_files_go_once_a_table_is_written(spark):
    from tidemark.llm.common import WRITING, written

    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in disk.getAllFiles().mkString("\n").split("\n") if x.endswith(".data")}

    before, settings = files(), {k: spark.conf.get(k) for k in WRITING}
    out = written(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "tidy")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert {k: spark.conf.get(k) for k in WRITING} == settings
    assert sorted(r["count"] for r in out.collect()) == [714] * 5 + [715] * 2


def test_a_step_gives_its_memory_back_after_its_last_batch(monkeypatch):
    """Workers that waited kept what their tasks had taken, beside those at work."""
    from tidemark.llm import common

    calls, pool = [], pa.default_memory_pool()
    monkeypatch.setattr(common, "returned", lambda f=common.returned: calls.append(pool.bytes_allocated()) or f())
    batches = [pa.record_batch([pa.array(["x" * 1000] * 1000)], ["a"])] * 3
    run = common.tidy(lambda batches: (b.slice(0, 1) for b in batches))(iter(batches))
    assert [b.num_rows for b in run] == [1, 1, 1] and len(calls) == 1
