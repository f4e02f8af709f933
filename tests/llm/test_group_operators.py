"""Mixing, dedup, archives and search against brute force."""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import exact_dedup, mixing, near_dedup, pivot_search, shingles, warc


def test_mixture_stays_within_a_block(spark):
    rows = [(i, "x" * (5 + i % 11), "abcde"[min(4, i % 7)]) for i in range(900)] + [(900 + i, "y" * 40, None) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = {"a": 5, "b": 3, "c": 3}
    got = mixing.positions(docs, targets, rest=2, block=50).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    group = {r.doc_id: r.source if r.source in targets else "rest" for r in got}
    weight = {**targets, "rest": 2}
    owner = {}
    for r in got:
        assert owner.setdefault(r.slot, group[r.doc_id]) == group[r.doc_id]
    blocks = defaultdict(dict)
    for r in got:
        blocks[group[r.doc_id]][r.block] = r.slot
    total = {g: sum(len(t) for k, t, _ in rows if group[k] == g) for g in weight}
    count = {g: -(-total[g] // 50) for g in weight}
    for own in blocks.values():
        order = [own[b] for b in sorted(own)]
        assert order == sorted(order)
    # While every group has a full period left, each prefix is less than one block from every share.
    n = sum(weight.values())
    periods = min(count[g] // weight[g] for g in weight)
    placed = Counter()
    for slot in range(periods * n):
        placed[owner[slot]] += 1
        for g, w in weight.items():
            assert abs(placed[g] - Fraction((slot + 1) * w, n)) < 1
    assert max(owner) + 1 == sum(count.values())


def test_mixture_of_odd_rows(odd, odd_rows, nothing):
    got = mixing.positions(odd, {"src0": 2, "src7": 1}, block=100).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in got) == sorted(k if k is not None else -1 for k, _ in odd_rows)
    mixed = mixing.mixture(odd, {"src0": 2}, block=100)
    assert mixed.columns == odd.columns and mixed.count() == len(odd_rows)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, odd.collect()))
    assert mixing.positions(nothing, {"src0": 2}).collect() == []
    assert mixing.mixture(nothing, {"src0": 2}).collect() == []
    with pytest.raises(ValueError, match="positive"):
        mixing.positions(odd, {"src0": 0})


def copies_by_force(rows):
    groups = defaultdict(list)
    for k, t in rows:
        groups["".join(c for c in t or "" if c not in exact_dedup.BLANKS)].append((-len(t or ""), k is None, k))
    out = []
    for content, members in groups.items():
        members.sort()
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(str(m[2]), str(members[0][2]), len(members), i == 0, sha) for i, m in enumerate(members)]
    return sorted(out)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.pmod(F.length(c), F.lit(3))])
def test_copies(odd, odd_rows, nothing, digest):
    got = exact_dedup.copies(odd, digest=digest, salts=3).collect()
    want = copies_by_force(odd_rows)
    assert sorted((str(r.key), str(r.keep), r["size"], r.kept) for r in got) == sorted(w[:4] for w in want)
    if digest is exact_dedup.sha256:
        assert sorted((str(r.key), str(r.keep), r["size"], r.kept, r.digest) for r in got) == want
    assert exact_dedup.copies(nothing, digest=digest).collect() == []


def test_copies_meet_in_their_partition_first(spark):
    rows = spark.range(0, 4000, 1, 4).select("id", F.monotonically_increasing_id().alias("row"), F.lit(1).alias("size"))
    rows = rows.select(F.col("id").alias("key"), "row", "size", F.lit("a").alias("content"), F.lit("d").alias("digest"))
    combined = exact_dedup._combined(rows, 64)
    assert [r.n for r in combined.collect()] == [4000]
    plan = combined._jdf.queryExecution().executedPlan()
    sent = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            sent.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    assert sent and max(sent) == 4


def test_rows_without_copies(odd, odd_rows, nothing):
    got = exact_dedup.without_copies(odd)
    assert got.columns == odd.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(w[0] for w in copies_by_force(odd_rows) if w[3])
    assert exact_dedup.without_copies(nothing).collect() == []


def test_archives(spark, tmp_path):
    rows = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""), (5, "v", "WARC/1.1\r\n\r\n\r\né")]
    rows += [(None, "w", "<p>x</p>"), (None, "n", "only"), (6, "r", "twice"), (6, "r", "twice"), (7, "l", "long " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    found = warc.read_archives(spark, path)
    payload = {(r.page, bytes(r.payload)) for r in found.collect() if r.type == "response"}
    assert payload == {(1, b"<p>x</p>"), (3, b""), (5, "WARC/1.1\r\n\r\n\r\né".encode()), (None, b"only"), (6, b"twice"), (7, b"long " * 50_000)}
    got = sorted((str(r.page), r.bytes, r.digest, r.type, r.refers_to) for r in warc.resolved(found).collect())
    first = {"<p>x</p>": 1, "": 3, "WARC/1.1\r\n\r\n\r\né": 5, "only": None, "twice": 6, "long " * 50_000: 7}
    want = []
    for page, _, html in rows:
        data, of = (html or "").encode(), first[html or ""]
        again = page != of
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((str(page), len(data), digest, "revisit" if again else "response", of if again else None))
    assert got == sorted(want)
    warc.write_archives(pages, str(tmp_path / "v"), least=9)
    types = {r.page: r.type for r in warc.read_archives(spark, str(tmp_path / "v"), payloads=False).collect()}
    assert types[2] == types[4] == "response"
    warc.write_archives(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).collect() == []


def test_archives_of_page_numbers_that_repeat(spark, tmp_path):
    rows = [(6, "u", "aaaa"), (6, "u", "bb"), (7, "u", "aaaa"), (8, "u", "bb"), (9, "u", "bb")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"))
    found = warc.resolved(warc.read_archives(spark, str(tmp_path / "w"), payloads=False)).collect()
    assert sorted((r.page, r.bytes, r.refers_to) for r in found) == [(6, 2, None), (6, 4, None), (7, 4, 6), (8, 2, 6), (9, 2, 6)]
    responses = [r.record for r in warc.read_archives(spark, str(tmp_path / "w")).filter("type = 'response'").collect()]
    assert len(set(responses)) == 2


def test_search(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(240)]
    rows += [(300, None), (400, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (600, [float("inf")] + [0.0] * 5), (None, [9.0] * 6)]
    rows += [(700, [1.0, 2.0]), (800, []), (17, rows[17][1]), (900, rows[100][1]), (1001, rows[100][1]), (100, rows[5][1])]
    frame = spark.createDataFrame([(k, v, "x") for k, v in rows], "vec_id bigint, embedding array<float>, score string")
    got = pivot_search.top_products(frame, F.col("vec_id") % 100 == 0, block=50, query_block=2, pivots=4, sample=20).collect()
    steps = {}
    clean = []
    for k, v in rows:
        if k is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = np.zeros(6)
        whole[: len(v)] = np.floor(1024 * np.array(v, np.float32).astype(float)) if v else 0
        clean.append((k, whole))
    want = Counter()
    for k, q in clean:
        if k % 100 == 0:
            best = sorted((-int(q @ x), i) for i, x in clean if i != k)[:10]
            want.update((k, r, i, -s) for r, (s, i) in enumerate(best, 1))
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
    assert not steps and pivot_search.top_products(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_search_beyond_exact_doubles():
    query = np.array([3e17, 1.0])
    got = pivot_search.products(query, np.array([[1.0, 1.0], [4e17, 0.0]]))
    assert got.tolist() == [300000000000000001, (1 << 63) - 1]


def words_of(text):
    import re

    return re.findall(r"\w+", (text or "").lower())


def cut(text, n=5):
    words = words_of(text)
    counts = Counter(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else Counter()
    return {k: 1 + math.log2(c) for k, c in counts.items()}


def weighted(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
    return total


def test_probability_jaccard():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a = {int(k): int(v) for k, v in zip(rng.integers(0, 30, 20), rng.integers(1, 4, 20), strict=True)}
        b = {int(k): int(v) for k, v in zip(rng.integers(0, 30, 20), rng.integers(1, 4, 20), strict=True)}
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        got = shingles.probability_jaccard(x, np.array([a[int(k)] for k in x]), y, np.array([b[int(k)] for k in y]))
        assert got == pytest.approx(weighted(Counter(a), Counter(b)))


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(5)
    common, only = rng.integers(0, 1 << 62, 300).astype(np.uint64), rng.integers(0, 1 << 62, 100).astype(np.uint64)
    a, b = np.sort(common), np.sort(np.concatenate((common[:250], only)))
    wa, wb = np.ones(len(a)), np.where(np.isin(b, only), 2.0, 1.0)
    wa[::7] = 3
    own = shingles.signatures(np.concatenate((a, b)), np.concatenate((wa, wb)), np.array([0, len(a), len(a) + len(b)]), 4096)
    want = shingles.probability_jaccard(a, wa, b, wb)
    assert (own[0] == own[1]).mean() == pytest.approx(want, abs=0.03)


def classes_by_force(rows, least=0.8):
    sets = [cut(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if words_of(rows[i][1]) == words_of(rows[j][1]) or weighted(sets[i], sets[j]) >= least:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    out = []
    for members in groups.values():
        low = min(members, key=lambda k: (k is None, k))
        out += [(str(k), str(low), len(members)) for k in members]
    return sorted(out)


def test_near_copies(odd, odd_rows, nothing):
    got = near_dedup.classes(odd).collect()
    want = classes_by_force([(k, None if t and len(t) > 5000 else t) for k, t in odd_rows if not (t and len(t) > 5000)])
    assert sorted((str(r.key), str(r.class_id), r.class_size) for r in got if r.key != 51) == want
    stay = near_dedup.without_near_copies(odd)
    assert stay.columns == odd.columns
    assert stay.count() == sum(r["first"] for r in got) == len({r.class_id for r in got})
    assert near_dedup.classes(nothing).collect() == []


def test_chains_of_near_copies(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 90])) for i in range(40)] + [(100 + i, " ".join(words[:200] + [f"z{i}"])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).cache()
    for rounds in (0, 2):
        got = near_dedup.classes(docs, star_rounds=rounds).collect()
        assert sorted((str(r.key), str(r.class_id), r.class_size) for r in got) == classes_by_force(rows)


def near_group(rng, base, copies, spoil):
    """Copies of a text with a few words changed; half of them share a change, and each word is chosen from a few."""
    rows = []
    for i in range(copies):
        words = list(base)
        if i % 2:
            words[20] = "shared"
        for at in rng.choice(len(words), rng.integers(0, spoil), replace=False):
            words[at] = f"v{rng.integers(0, 5)}"
        rows.append(" ".join(words))
    return rows


def classes_by_matrix(texts, words=5, similar=0.8):
    """Sizes of the classes of texts that repeat no shingle, by the Jaccard similarities of all pairs."""
    cut = [{tuple(t.split()[i : i + words]) for i in range(len(t.split()) - words + 1)} for t in texts]
    assert all(len(c) == len(t.split()) - words + 1 for c, t in zip(cut, texts, strict=True))
    column = {s: j for j, s in enumerate(set().union(*cut))}
    has = np.zeros((len(texts), len(column)), np.float32)
    for i, c in enumerate(cut):
        has[i, [column[s] for s in c]] = 1
    size, label = has.sum(axis=1), np.full(len(texts), -1)
    for start in range(len(texts)):
        if label[start] >= 0:
            continue
        label[start], waiting = start, [start]
        while waiting:
            at = waiting.pop()
            common = has @ has[at]
            near = np.flatnonzero((common / (size + size[at] - common) >= similar - 1e-9) & (label < 0))
            label[near] = start
            waiting += near.tolist()
    return label


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """2,000 near copies: the classes of all pairs, found with a fraction of the pairs."""
    rng = np.random.default_rng(4)
    texts = near_group(rng, [f"w{i}" for i in range(140)], 2000, 9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6).cache()
    compared = []
    plain = near_dedup._verified
    monkeypatch.setattr(near_dedup, "_verified", lambda pairs, table, least: compared.append(pairs.count()) or plain(pairs, table, least))
    got = {r.key: r.class_id for r in near_dedup.classes(docs).collect()}
    label = classes_by_matrix(texts)
    assert len(set(label)) > 5
    assert got == {i: int(label[i]) for i in range(len(texts))}
    assert sum(compared) < 10 * len(texts)


def test_rounds_write_few_tables(spark, monkeypatch):
    """With many shuffle partitions each table costs as many small tasks and files, whatever its size."""
    texts = near_group(np.random.default_rng(4), [f"w{i}" for i in range(140)], 60, 9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3).cache()
    written = []
    plain = near_dedup.settle
    monkeypatch.setattr(near_dedup, "settle", lambda df, name: written.append(name) or plain(df, name))
    got = {r.key: r.class_id for r in near_dedup.classes(docs).collect()}
    label = classes_by_matrix(texts)
    assert got == {i: int(label[i]) for i in range(len(texts))}
    assert len(set(label)) > 1
    assert len(written) <= 40


def test_a_group_with_weights(spark):
    """Near copies of a text that repeats a phrase: counts weigh, and the bound for weighted texts holds."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)] + ["again and again and so on and so forth"] * 4
    rows = list(enumerate(near_group(rng, " ".join(base).split(), 120, 8)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).cache()
    for rounds in (0, 2):
        got = near_dedup.classes(docs, star_rounds=rounds).collect()
        assert sorted((str(r.key), str(r.class_id), r.class_size) for r in got) == classes_by_force(rows)


def test_a_long_repetitive_text(spark, odd_rows):
    """Key 51, the long text of repeated passages, with near copies of its own."""
    long = next(t for k, t in odd_rows if k == 51)
    rows = [(51, long), (70, long + " end"), (71, long.replace("daily", "weekly", 3)), (72, " ".join(reversed(long.split()))), (73, long[: len(long) // 2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = near_dedup.classes(docs).collect()
    assert sorted((str(r.key), str(r.class_id), r.class_size) for r in got) == classes_by_force(rows)
