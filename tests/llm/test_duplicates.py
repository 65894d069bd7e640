"""Exact, near and byte-string duplicates, and benchmark items, against brute force."""

import hashlib
import random
from collections import defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.llm import components as components_module
from tabloom.llm import decontaminate, exact_dedup, heavy, ngram_join, suffix_dedup
from tabloom.llm.components import components
from tabloom.llm.heavy import merge_counters

FOLDER = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("key", T.StringType())])


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], DOCS)


def texts_of(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()


def test_misra_gries_error_bound():
    rng = random.Random(3)
    stream = [rng.choice("aaaabbc") if rng.random() < 0.5 else str(rng.randint(0, 500)) for _ in range(5000)]
    counters: dict = {}
    for item in stream:
        counters = merge_counters(counters, {item: 1}, 20)
    for item in "ab":
        assert stream.count(item) - len(stream) / 21 <= counters[item] <= stream.count(item)


@pytest.mark.parametrize("share, counters", [(1 / 1024, 4096), (0.2, 8), (2.0, 1)])
def test_exact_duplicates(spark, share, counters):
    rows = [(k, "Hot TEXT") for k in range(60)] + [(100 + k, f"t{k % 7}") for k in range(20)] + [(200, None), (201, ""), (202, "É"), (203, "é"), (204, "x" * 200_000), (204, "x" * 200_000), (None, "n"), (None, "t1")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))].append(i)
    wanted = []
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        wanted += [(str(i), keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    found = exact_dedup.exact_duplicates(docs_of(spark, rows), share=share, counters=counters).collect()
    rows_of = [(str(r.doc_id), r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found]
    assert sorted(rows_of, key=str) == sorted(wanted, key=str)
    assert exact_dedup.exact_duplicates(docs_of(spark, [])).count() == 0


def test_only_heavy_keys_are_broadcast(spark):
    keyed = spark.createDataFrame([(bytes([k % 50]),) for k in range(2000)] + [(b"hot",)] * 700, "key binary").repartition(4)
    assert [bytes(r.key) for r in heavy.frequent_keys(keyed, 0.2, 30).collect()] == [b"hot"]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(4000, 4050)] + [(7, 7)]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {x: root(x) for x in parent}


def test_plans_of_components_stay_small(spark, monkeypatch):
    """They are the driver's work: its memory must not follow the copies of a star in a plan or the rounds."""
    lines, digits = [], []

    def seen(store):
        def run(df, *rest):
            plan = df._jdf.queryExecution().optimizedPlan()
            lines.append(len(plan.toString().splitlines()))
            digits.append(len(str(plan.stats().sizeInBytes())))
            return store(df, *rest)

        return run

    for name in ("cut_lineage", "_written"):
        monkeypatch.setattr(components_module, name, seen(getattr(components_module, name, None)), raising=False)
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {k: 0 for k in range(301)} | {k: 1000 for k in range(1000, 1100)}
    assert len(lines) > 6 and max(lines) < 80 and max(digits) < 100


def near_by_brute_force(rows):
    sets = {i: (lambda w: frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None)(ngram_join.words_of(t or "")) for i, t in rows}
    rep = {}
    for i in sorted(sets):
        rep.setdefault(sets[i], i)
    own = [(i, s) for s, i in rep.items() if s]
    parent, links = {i: i for i, _ in own}, defaultdict(int)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(own, 2):
        both = len(x & y)
        if both and both >= 0.8 * (len(x) + len(y) - both) - 1e-9:
            links[a] += 1
            links[b] += 1
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (rep[s], root(rep[s]), links[rep[s]]) if s else (i, i, 0) for i, s in sets.items()}


def near_copies(seed=8, many=150):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(120)] for _ in range(4)]
    rows = []
    for k in range(many):
        words = list(base[k % 4])
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = word()
        rows.append((k, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, " ".join(word() for _ in range(30_000)))]


@pytest.mark.parametrize("block, leaf, pivots", [(1024, 48, 32), (8, 4, 2), (3, 2, 1)])
def test_near_duplicates(spark, monkeypatch, block, leaf, pivots):
    for name, value in (("BLOCK", block), ("EXACT_BLOCK", block), ("LEAF", leaf), ("PIVOTS", pivots)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies()
    found = {r.doc_id: (r.rep_id, r.class_id, r.n_links) for r in ngram_join.near_duplicates(docs_of(spark, rows + [(None, "x y"), (3, rows[3][1])])).collect()}
    assert found == near_by_brute_force(rows)


def test_near_duplicates_on_documents(spark):
    found = {r.doc_id: (r.rep_id, r.class_id, r.n_links) for r in ngram_join.op6_ngram_join(spark, FOLDER).collect()}
    assert found == near_by_brute_force(texts_of(FOLDER))
    assert ngram_join.near_duplicates(docs_of(spark, [])).count() == 0


def test_large_buckets_connect_what_all_pairs_connect(spark):
    """Pivots find the same classes as comparing all rows of a bucket, chains and neighbouring classes included."""
    rng = np.random.default_rng(7)
    rows = []
    for path in range(3):
        base = rng.integers(0, 256, (3, ngram_join.SAMPLES))
        base[1, :40] = base[0, :40]
        now = base[2]
        for k in range(160):
            own = base[k % 2].copy() if k < 120 else now.copy()
            change = rng.permutation(ngram_join.SAMPLES)[: rng.integers(0, 20) if k < 120 else 9]
            own[change] = rng.integers(0, 256, len(change))
            now = own if k >= 120 else now  # a chain whose ends are far apart
            rows.append((path, path * 1000 + k, 160, 100, [int(v) for v in own]))
    members = spark.createDataFrame(rows, "path bigint, rep bigint, n bigint, size int, samples array<int>")
    whole = components(ngram_join.sampled_links(members, 0.8, block=1000)).collect()
    assert 5 < len({r.root for r in whole}) < 200
    for block, pivots in ((40, 8), (7, 1), (150, 400)):
        assert sorted(components(ngram_join.sampled_links(members, 0.8, block, pivots)).collect()) == sorted(whole)


@pytest.mark.parametrize("edits", [3])
def test_rows_grow_with_a_class_and_not_with_its_square(spark, edits):
    rng = random.Random(edits)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(300)]
    made = {}
    for n in (500, 1000, 2000):
        rows = []
        for k in range(n):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(300)] = word()
            rows.append((k, " ".join(words)))
        sketches = ngram_join.text_sketches(docs_of(spark, rows).select(F.col("doc_id").alias("id"), "text"))
        sets = ngram_join.cut_lineage(sketches.select(F.col("id").alias("rep"), "samples", "size"))
        met = ngram_join.buckets(sets, 0.8, 4).join(sets.select("rep", "samples", "size"), "rep")
        hashes = spark.createDataFrame([(0, k, ngram_join.shingle_set(t).tobytes()) for k, t in rows], "root bigint, rep bigint, hashes binary")
        links = ngram_join.sampled_links(met, 0.8, block=300).count()
        exact = ngram_join.exact_links(ngram_join.cut_lineage(ngram_join.differences(hashes, hashes.filter("rep = root"), 0.8)), 0.8)
        made[n] = links, exact.count()
        assert exact.groupBy("rep").agg(F.sum("n_links").alias("k")).filter(f"k < {n // 2}").count() == 0
    for k in (0, 1):
        print(made)
        assert made[2000][k] < 3 * made[1000][k] and made[2000][k] < 40 * 2000, made


def test_runs_reach_the_recall():
    assert ngram_join.missed(0.8, ngram_join.runs_for(0.9999)) < 7e-4
    assert ngram_join.missed(0.9, ngram_join.runs_for(0.9999)) < 1e-5
    chance = ngram_join.survival(0.8, ngram_join.DEPTH)
    assert (1 - chance) ** ngram_join.runs_for(0.9999) <= 1e-4 < (1 - chance) ** (ngram_join.runs_for(0.9999) - 1)


def repeats_by_brute_force(rows):
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = True
            seen.add(s)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("bucket_rows, group_rows", [(250_000, 131_072), (60, 2)])
def test_repeats(spark, bucket_rows, group_rows):
    rng = random.Random(2)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    line, other = letters(170), letters(230)
    rows = [(k, letters(rng.randint(0, 300)) + line[rng.randint(0, 20) :] + letters(50) + other[: rng.randint(90, 230)]) for k in range(40)]
    rows += [(50, "ab" * 3000), (51, "ab" * 200), (52, None), (53, ""), (54, line), (55, line), (56, "x" * 99), (57, "x" * 99), (58, letters(40_000)), (3, rows[3][1])]
    found = suffix_dedup.remove_repeats(docs_of(spark, rows + [(None, line)]), bucket_rows=bucket_rows, group_rows=group_rows).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == repeats_by_brute_force(rows)
    assert len(found) == len(rows)
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).count() == 0


def test_repeats_of_an_anchor_at_a_batch_edge(spark):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    line, edge = letters(400), suffix_dedup.CHUNK // 2
    text = letters(edge - 11) + "x" + line + "y" + letters(50) + "z" + line + "w"
    at, first, last = suffix_dedup.anchors(suffix_dedup.Texts([text.encode()]))
    twin = np.flatnonzero(last == edge - 1)[0]
    assert at[twin] == at[twin + 1] and first[twin] < edge - 10 and first[twin + 1] == edge
    found = suffix_dedup.remove_repeats(docs_of(spark, [(1, text)]), group_rows=2).collect()
    kept = text[: -len(line) - 1] + "w"
    assert [(r.n_removed, r.n_spans, r.kept_sha256) for r in found] == [(len(line), 1, hashlib.sha256(kept.encode()).hexdigest())]


def test_whole_copies_make_no_suffixes_and_groups_are_split_without_a_shuffle(spark, monkeypatch):
    """Texts that are whole copies are out before the suffixes are made; rows meet the keys of the large groups by a broadcast."""
    rng, seen, plans = random.Random(9), [], []
    text = "".join(rng.choice("abcdef ") for _ in range(400))
    rows = [(k, text) for k in range(20)] + [(100 + k, chr(65 + k) + text[50:300]) for k in range(30)]
    tied, within = suffix_dedup.tied_suffixes, suffix_dedup.within_groups
    monkeypatch.setattr(suffix_dedup, "tied_suffixes", lambda docs, *more: seen.append(sorted(r.id for r in docs.collect())) or tied(docs, *more))
    monkeypatch.setattr(suffix_dedup, "within_groups", lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or within(rows))
    found = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(docs_of(spark, rows), group_rows=4).collect()}
    assert found == {0: 0} | {k: 400 for k in range(1, 20)} | {100 + k: 250 for k in range(30)}
    assert seen == [[0, *range(100, 130)]]
    assert plans and not any("SortMergeJoin" in p for p in plans)


def test_repeats_on_documents(spark):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op5_suffix_dedup(spark, FOLDER).collect()}
    assert found == repeats_by_brute_force(texts_of(FOLDER))


def test_sketch_cannot_miss():
    for n in range(1, 400):
        upper = 1 << (n - 1).bit_length()
        k = decontaminate.sketch_length(upper, 0.8)
        missing = n - int(np.ceil(0.8 * n - 1e-9))
        assert k > missing


def test_contaminated(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((3, 5, 6, 20, 50, 64))] + [(10, None), (11, ""), (None, "a b c d e f")]
    rows = []
    for k in range(30):
        words = [word() for _ in range(rng.choice((0, 30, 3000)))]
        own = rng.choice(items[:6])[1].split()
        cut = own[: rng.randint(max(1, len(own) // 2), len(own))]
        at = rng.randint(0, len(words))
        rows.append((k, " ".join(words[:at] + cut + words[at:]).upper() + "\n"))
    rows += [(40, None), (41, items[0][1]), (42, items[4][1]), (42, items[4][1]), (None, items[4][1])]

    def runs(text):
        w = (text or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    wanted = set()
    for i, t in rows:
        for j, b in items:
            if i is not None and j is not None and runs(b) and len(runs(t) & runs(b)) >= 0.8 * len(runs(b)) - 1e-9:
                wanted.add((i, j, len(runs(t) & runs(b)), len(runs(b))))
    item_rows = spark.createDataFrame([(j, b, "clash") for j, b in items], "item_id bigint, text string, hash string")
    found = decontaminate.contaminated(docs_of(spark, rows), item_rows).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found} == wanted and len(found) == len(wanted) > 5
    assert decontaminate.contaminated(docs_of(spark, []), item_rows).count() == 0
    assert decontaminate.contaminated(docs_of(spark, rows), item_rows.limit(0)).count() == 0


def test_decontamination_is_native(spark):
    plan = decontaminate.op7_decontaminate(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if word in plan]
