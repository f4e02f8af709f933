"""Decontamination, Merkle manifest and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, merkle, registry, spelling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM_SCHEMA = "item_id bigint, text string, row int, `window` int, shingle string"


def ascii_lower(text):
    return "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def benchmark_rows(odd_rows):
    words = WORD.findall(ascii_lower(odd_rows[0][1]))
    most = WORD.findall(ascii_lower(odd_rows[3][1]))
    return [
        (1, " ".join(words[5:30])),
        (10, "-- ".join(words[20:40]).upper()),
        (2, " ".join(most[3:7])),
        (3, "one TWO"),
        (4, "a"),
        (5, None),
        (6, " \n"),
        (None, " ".join(words[5:16])),
        (1, " ".join(most[40:60])),
        (7, "not to be found anywhere in the texts that are given here at all"),
        (8, " ".join([*words[5:14], "else"])),
        (9, "x" * 300),
    ]


def hits_by_force(text, items, window=10):
    words = WORD.findall(ascii_lower(text))
    hit, found = set(), set()
    for item, body in items:
        own = WORD.findall(ascii_lower(body))
        size = min(window, len(own))
        cuts = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for at in range(len(words) - size + 1 if size else 0):
            if tuple(words[at : at + size]) in cuts:
                hit.update(range(at, at + size))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize(("most", "shingle"), [(250_000, 5), (0, 5), (250_000, 3)])
def test_contamination_by_force(spark, odd, odd_rows, most, shingle):
    items = benchmark_rows(odd_rows)
    table = spark.createDataFrame([(i, t, 1, 2, "s") for i, t in items], ITEM_SCHEMA)
    found = decontaminate.contamination(odd, table, most=most, shingle=shingle).collect()
    expected = [(k, *hits_by_force(t, items)) for k, t in odd_rows]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = [(r["key"], r["n_words"], r["n_hit"], list(r["items"])) for r in found]
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert all(r["n_items"] == len(r["items"]) for r in found)
    kept = decontaminate.without_contaminated(odd, table, most=most, shingle=shingle)
    assert kept.columns == odd.columns
    assert kept.count() == sum(not e[2] for e in expected)


def test_contamination_of_nothing(spark, odd, odd_rows, nothing):
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert decontaminate.contamination(odd, none).filter("n_hit > 0 OR n_items > 0").isEmpty()
    assert decontaminate.contamination(odd, none).count() == len(odd_rows)
    assert decontaminate.contamination(nothing, spark.createDataFrame([(1, "a b", 1, 1, "")], ITEM_SCHEMA)).isEmpty()


def test_contamination_scan_has_no_python_and_spells_nothing_twice(spark, odd):
    table = spark.createDataFrame([(1, "the store keeps a list of daily sales and each", 1, 2, "s")], ITEM_SCHEMA)
    _, _, shingles = decontaminate._benchmark(table, "item_id", "text", 10, 5)
    plan = decontaminate._occurrences(odd, "text", shingles, [5], 10)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "BroadcastHashJoin [xxhash64" in plan  # the code alone is the key


# ---------------------------------------------------------------------------------------------------------------------


def enter(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree_by_force(leaves, fanout):
    """Root, and per leaf its (left, right) siblings from below."""
    level, place, ways = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i in range(len(leaves)):
            start = place[i] // fanout * fanout
            run = level[start : start + fanout]
            at = place[i] - start
            ways[i].append(("".join(run[:at]), "".join(run[at + 1 :])))
            place[i] //= fanout
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], ways


def manifest_by_force(rows, fanout):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc, text, lang, source, n in rows:
        groups.setdefault(source, []).append((doc, sha(enter(doc, source, lang, n, text))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append((own, *tree_by_force([d for _, d in own], fanout)))
    root, upper = tree_by_force([t[1] for t in trees], fanout)
    out = []
    for (own, subroot, ways), above in zip(trees, upper, strict=True):
        for (doc, digest), way in zip(own, ways, strict=True):
            out.append((doc, digest, subroot, root, [*way, *above]))
    return out


def as_rows(found):
    order = lambda r: (r[0] is None, r[0] or 0, r[1], str(r[4]))
    return sorted(found, key=order)


@pytest.mark.parametrize(("fanout", "levels"), [(3, 6), (3, 1), (2, 2)])
def test_manifest_by_force(odd, fanout, levels):
    rows = odd.select("doc_id", "text", "lang", "source", "n_chars").collect()
    found = merkle.manifest(odd, fanout=fanout, levels=levels).collect()
    got = [(r["key"], r["leaf"], r["subroot"], r["root"], [(p["left"], p["right"]) for p in r["path"]]) for r in found]
    assert as_rows(got) == as_rows(manifest_by_force([tuple(r) for r in rows], fanout))
    assert all(r["folded_root"] == r["root"] for r in found)


def test_manifest_of_many_rows_and_of_changed_ones(spark):
    docs = spark.range(2000).selectExpr(
        "id AS doc_id", "concat('t', id, '\n') AS text", "'en' AS lang", "if(id % 3 = 0, 'hot', concat('s', id % 40)) AS source", "id AS n_chars"
    )
    text = F.when(F.col("doc_id") % 5 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    changed = merkle.leaf_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text)
    found = merkle.manifest(docs, claimed=changed, levels=2).collect()
    expected = manifest_by_force([(i, f"t{i}\n", "en", "hot" if i % 3 == 0 else f"s{i % 40}", i) for i in range(2000)], 3)
    got = [(r["key"], r["leaf"], r["subroot"], r["root"], [(p["left"], p["right"]) for p in r["path"]]) for r in found]
    assert as_rows(got) == as_rows(expected)
    assert all((r["folded_root"] == r["root"]) == (r["key"] % 5 != 0) for r in found)


def test_manifest_of_few_rows(spark, nothing):
    assert merkle.manifest(nothing).isEmpty()
    one = spark.createDataFrame([(None, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    (row,) = merkle.manifest(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == sha("-----")
    assert row["path"] == []


# ---------------------------------------------------------------------------------------------------------------------


def vocabulary_by_force(rows, one_in, least_chars=7):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_force(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def spelling_rows():
    rng = random.Random(11)
    parts = ["re", "ba", "lon", "tre", "ñu", "ei", "st", "aaa", "ÿx"]
    base = ["".join(rng.choice(parts) for _ in range(4)) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "baaaaaa", "abababab", "babababa", "Élégance"]
    rows = []
    for i in range(900):
        word = rng.choice(base) if rng.random() < 0.5 else base[min(int(rng.expovariate(0.3)), 39)]
        if rng.random() < 0.3:
            at, c = rng.randrange(len(word) + 1), rng.choice("abñz")
            word = rng.choice((word[:at] + c + word[at:], word[:at] + word[at + 1 :], word[:at] + c + word[at + 1 :]))
        rows.append((i % 70, f"{word} {word.upper()}, {word}9{rng.choice(base)}"))
    return rows + [(None, None), (None, ""), (3, "short 12"), (None, "elegance elegance"), (5, "q" * 5000 + " " + "q" * 5000)]


@pytest.mark.parametrize("one_in", [31, 3])
def test_variants_by_force(spark, one_in):
    rows = spelling_rows()
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id bigint, text string, word int, n string").repartition(3)
    found = spelling.spelling_variants(docs, one_in=one_in).select("word", "form", "root", "n", "n_near", "form_n")
    expected = variants_by_force(vocabulary_by_force(rows, one_in))
    assert any(e[1] for e in expected)
    assert sorted(map(tuple, found.collect())) == expected


def test_variants_of_dense_words(spark):
    """All words over two letters: many ties in rarity, every word near to many."""
    rng = random.Random(3)
    words = {"".join("ab"[i >> k & 1] for k in range(size)): rng.choice((2, 3, 25, 300, 4000)) for size in (7, 8) for i in range(2**size)}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(4)
    found = spelling.variants(table).select("word", "form", "root", "n", "n_near", "form_n")
    expected = variants_by_force(words)
    assert any(e[2] != (e[1] or e[0]) for e in expected)  # ways of several forms
    assert sorted(map(tuple, found.collect())) == expected


def test_variants_of_nothing(nothing):
    assert spelling.spelling_variants(nothing).isEmpty()


def test_pivots_are_disjoint_and_rarest():
    rank = {g: i for i, g in enumerate(["ab", "bc", "cd", "de", "ef", "fg"])}
    assert spelling.signature("abcdefg", rank, [1, 2, 3, 4, 5, 6]) == (0, 2, 2, [0, 1, 2])
    same = {"aa": 0}
    left, right, last, places = spelling.signature("aaaaaaa", same, [9])
    assert (left, last, places) == (0, 0, [0, 1, 2, 3, 4, 5]) and right >= 2


def test_registered_queries_agree_on_columns():
    assert {"op11_decontaminate", "op12_merkle_manifest", "op13_spelling_variants"} <= set(registry.QUERIES) & set(registry.ORACLE)
