"""Text operators against the libraries and plain expressions they must agree with."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from shelfspark.llm import automata, batches, byte_bpe, registry, secret_scan, token_counts, token_files

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PARTS = (
    "token TOKEN secret password passwd api_key ApiKey = : ' \" AKIA ABCDEFGHIJ0123456789 AKIA0 0123456789abcdef deadbeef "
    "é abc 12 xyz - 日本 == the tion <s> </s> <|endoftext|> aaaa 's 'll ---- abab 𝔘 ▁ !! ing"
).split(" ") + [" ", " ", " ", "  ", "    ", "\n", "\t", "\r\n", " \n ", "\x00", "\x01", " "]


def strings(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(n)] + ["", " ", "  ", "a" * 3000, " " * 900 + "b"]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s, e, secret_scan.BASE[k]) for s, k, e in sorted(found)]


@pytest.mark.parametrize("pattern", ["ab+c|abd", "(?i:x_?y)[0-9]{2,4}z*", "a{3}|a{5,}", r"[\x20-\x2f\.]+q?"])
def test_automaton_marks_where_matches_end(pattern):
    rng = random.Random(1)
    data = bytes(rng.choice(b"abcdxyXY_019z .q") for _ in range(3000))
    at, _ = automata.marks(automata.compile_patterns([pattern], anywhere=True), np.frombuffer(data, np.uint8), lanes=16)
    own = re.compile(pattern.encode())
    want = {e for e in range(1, len(data) + 1) if any(own.fullmatch(data, s, e) for s in range(max(0, e - 40), e))}
    got = {int(x) + 1 for x in at}
    assert got >= want
    assert all(any(own.fullmatch(data, s, e) for s in range(e)) for e in got - want)  # matches of over 40 bytes


def test_secrets_equal_plain_expressions():
    texts = strings(4000, 3)
    scanner = secret_scan.scanner(secret_scan.RULES)
    data = [t.encode() for t in texts]
    for text, own, spans in zip(texts, data, scanner.spans(data), strict=True):
        points = secret_scan._code_points(own, sorted(spans))
        got = [(s, e, secret_scan.RULES[r].kind) for s, r, e in points if r < 3]
        assert got == base_spans(text)


def test_other_kinds_of_secrets():
    scanner = secret_scan.scanner(secret_scan.RULES)
    text = b"ghp_" + b"Zz" * 18 + b" xoxb-1234567890-ab -----BEGIN RSA PRIVATE KEY----- ghp_short"
    kinds = [secret_scan.RULES[r].kind for _, r, _ in sorted(scanner.spans([text])[0])]
    assert kinds == ["github", "slack", "private_key"]


def test_secret_query_on_odd_rows(odd, odd_rows, nothing):
    rows = secret_scan.find_secrets(odd).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, list(zip(r.starts, r.ends, r.kinds, strict=True))) for r in rows)
    assert got == sorted((k if k is not None else -1, base_spans(t or "")) for k, t in odd_rows)
    assert secret_scan.find_secrets(nothing).collect() == []


def test_token_counts_equal_the_library(odd, odd_rows, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    own = token_counts.transducer(registry.PIECES)
    texts = strings(4000, 4)
    assert own.counts(pa.array(texts, pa.large_string())).tolist() == [len(library.encode(t)) for t in texts]
    rows = token_counts.count_tokens(odd, registry.PIECES, limit=100).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    want = []
    for k, t in odd_rows:
        n = len(library.encode(t or ""))
        want.append((k if k is not None else -1, len((t or "").encode()), n, n > 100))
    assert got == sorted(want)
    assert token_counts.count_tokens(nothing, registry.PIECES).collect() == []


def test_token_counts_when_states_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_STATES", 50)
    monkeypatch.setattr(token_counts, "KEPT_CHUNKS", 20)
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    own = token_counts.Transducer(token_counts.transducer(registry.PIECES).scores)
    for part in range(4):
        texts = strings(50, part)
        assert own.counts(pa.array(texts, pa.large_string())).tolist() == [len(library.encode(t)) for t in texts]


def tiktoken_library():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(registry.RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library():
    library, own = tiktoken_library(), byte_bpe.ranks(registry.RANKS, P.PATTERN)
    rng = random.Random(9)
    words = [bytes(rng.choice(b"abcdefgh") for _ in range(rng.randint(1, 500))) for _ in range(60)]
    words += [b"a" * 700, b"ab" * 300, bytes(rng.randrange(256) for _ in range(400)), b"=" * 90]
    ranks = own.words(words)
    assert [library.decode_bytes(x) for x in ranks] == words
    for word, ids in zip(words, ranks, strict=True):
        if word.isascii() and word.isalpha():
            assert ids == library.encode_ordinary(word.decode())


def test_byte_bpe_round_trip(spark, odd, odd_rows, nothing):
    library = tiktoken_library()
    more = spark.createDataFrame(list(enumerate(strings(400, 6), 1000)), "doc_id bigint, text string")
    rows = odd.select("doc_id", "text").union(more)
    want = []
    for k, t in [*odd_rows, *enumerate(strings(400, 6), 1000)]:
        ids = library.encode_ordinary(t or "")
        line = " ".join(map(str, ids)).encode()
        want.append((k if k is not None else -1, len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = byte_bpe.round_trip(rows, registry.RANKS, P.PATTERN).collect()
    assert sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got) == sorted(want)
    encoded = byte_bpe.encode(rows, registry.RANKS, P.PATTERN)
    decoded = byte_bpe.decode(encoded, registry.RANKS, P.PATTERN).collect()
    texts = sorted((t or "").encode() for _, t in [*odd_rows, *enumerate(strings(400, 6), 1000)])
    assert sorted(bytes(r.decoded) for r in decoded) == texts
    assert byte_bpe.round_trip(nothing, registry.RANKS, P.PATTERN).collect() == []


@pytest.mark.parametrize("least", [token_files.LEAST_PAIRS, 5])
def test_grammar_gives_the_ids_back(least):
    rng = np.random.default_rng(2)
    ids = np.concatenate([np.tile([7, 7, 7, 8], 300), rng.integers(0, 9, 5000), np.full(64, 3)]).astype(np.int32)
    last = np.zeros(len(ids), bool)
    last[rng.choice(len(ids), 60, replace=False)] = True
    last[-1] = True
    symbols, ends, rules = token_files.compress(ids, last.copy(), 10, least)
    lengths = token_files.rule_lengths(10, rules)
    sizes = [1] * 10
    for a, b in rules.tolist():
        sizes.append(sizes[a] + sizes[b])
    assert lengths.tolist() == sizes[10:]
    grammar = token_files.Grammar(10, rules, symbols, lengths)
    for a, b in [(0, 0), (0, 1), (17, 90), (1199, 1203), (5000, 10**6)]:
        assert grammar.slice(a, b).tolist() == ids[a:b].tolist()
    if least == 2:  # no pair repeats within documents, but where neighbours are equal
        pairs = [(a, b) for a, b, e in zip(symbols.tolist(), symbols.tolist()[1:], ends.tolist(), strict=False) if not e and a != b]
        assert len(pairs) == len(set(pairs))
    assert (grammar.ids() == ids).all() and len(symbols) < len(ids) / 2
    stops = np.flatnonzero(ends) + 1
    assert (np.cumsum([grammar.lengths[symbols[a:b]].sum() for a, b in zip([0, *stops[:-1]], stops, strict=True)]) == np.flatnonzero(last) + 1).all()
    assert len(token_files.compress(ids[:1], np.ones(1, bool), 10)[0]) == 1


def test_token_files(spark, odd, odd_rows, nothing, tmp_path, monkeypatch):
    library = Tokenizer.from_file(registry.TOKENIZER)
    token_files.write_tokens(odd, registry.TOKENIZER, P.PATTERN, str(tmp_path / "f"), 2)
    got = [tuple(r) for r in token_files.read_tokens(spark, str(tmp_path / "f")).collect()]
    assert len(got) == len(odd_rows)
    got.sort(key=lambda r: r[1])
    keys = [r[0] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    at, texts = 0, {}
    for k, t in odd_rows:
        texts.setdefault(k, []).append(t or "")
    for key, start, n, crc in got:
        ids = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts[key]]
        sums = [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids]
        assert start == at and (n, crc) in sums
        at += n
    row = max((r.asDict() for r in spark.read.parquet(str(tmp_path / "f")).collect()), key=lambda r: max(r["counts"]))
    for document, (_, ids) in enumerate(token_files.shard_documents(row)):
        a, b = len(ids) // 3, 2 * len(ids) // 3 + 1
        assert token_files.read_ids(row, document, a, b).tolist() == ids[a:b].tolist()
    token_files.write_tokens(nothing, registry.TOKENIZER, P.PATTERN, str(tmp_path / "g"), 2)
    assert token_files.read_tokens(spark, str(tmp_path / "g")).collect() == []


def test_many_chunks_go_to_the_library_in_one_text(monkeypatch):
    library, own = Tokenizer.from_file(registry.TOKENIZER), token_files.encoder.__wrapped__(registry.TOKENIZER, P.PATTERN)
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return library.encode_batch_fast(texts, **how)

    own.tokenizer = Counting()
    monkeypatch.setattr(token_files, "KEPT", 300)  # the store of repeated chunks begins anew now and then
    rng = random.Random(4)
    odd = [*"aabbcc  e'''srtl.,;12 3\t\n\r\x0b\x1c\x85\xa0\u3000\u2009\u180eñß日。’_<|>\x7f\x00", "<|endoftext|>", "'re", "'ll", " the"]
    words = [None, "", " ".join(str(k) + "x" for k in range(4000))]
    for _ in range(20):
        texts = words + ["".join(rng.choices(odd, k=rng.randrange(60))) for _ in range(100)]
        ids, ends = own.texts(batches.whole(pa.array(texts, pa.string())))
        got = [x.tolist() for x in np.split(ids, ends)][:-1]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        words = []
    sent.clear()
    own.texts(batches.whole(pa.array([" ".join(str(k) + "y" for k in range(4000))])))
    assert len(sent) < 100


def test_chunks_are_cut_at_punctuation_and_white_space():
    texts = pa.array(["", "it's so. it\n\nno", "é  a\u3000 b<|c|>", ""], pa.large_string())
    names, index, offsets = batches.chunked(texts, np.array([False, False, True, False]))
    parts = [names[i].as_py() for i in index.tolist()]
    assert parts == ["it", "'s", " so", ".", " it", "\n\nno", "é  a\u3000 b<|c|>"] and offsets.tolist() == [0, 0, 6, 7, 7]
    names, index, _ = batches.chunked(texts.slice(2))
    assert [names[i].as_py() for i in index.tolist()] == ["é", "  a\u3000 b", "<|c", "|>"]


def test_repeated_chunks_are_encoded_once(monkeypatch):
    library, own = tiktoken_library(), byte_bpe.Ranks(registry.RANKS, P.PATTERN)
    given, lists = [], own.lists
    monkeypatch.setattr(own, "lists", lambda words: given.extend(words.to_pylist()) or lists(words))

    def check(texts, kept):
        monkeypatch.setattr(byte_bpe, "KEPT", kept)
        names, index, offsets = own.chunked(pa.array(texts))
        written, spelt, number = own.round_trips(names, np.bincount(index, minlength=len(names)))
        assert number.tolist() == [len(library.encode_ordinary(c)) for c in names.to_pylist()]
        for t, a, b in zip(texts, offsets, offsets[1:], strict=False):
            line = b"".join(written[i].as_py() for i in index[a:b].tolist())
            assert line == "".join(f" {x}" for x in library.encode_ordinary(t)).encode()
            assert b"".join(spelt[i].as_py() for i in index[a:b].tolist()) == t.encode()

    check(["a zzqx. zzqx, zzqx! (zzqx) yy", "", " once"], 1000)
    assert sorted(given) == sorted([b"a", b" zzqx", b".", b",", b"!", b" (", b"zzqx", b")", b" yy", b" once"])
    given.clear()
    check(["b zzqx; zzqx: once"], 1000)
    assert b" zzqx" not in given and b" once" in given
    for part in range(12):  # the store begins anew now and then
        check(strings(40, part % 3), 60)
        assert len(own.names) <= 60 and own.names.to_pylist() == [d.decode() for d in own.kept[1].to_pylist()]


def test_words_that_reach_over_cuts_are_not_cut():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(registry.RANKS, "rb"))}
    assert batches.cuts_hold(P.PATTERN)
    for pattern in (r"\s+|\S+", r" ?[\p{L}\p{N}]+| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+"):
        assert not batches.cuts_hold(pattern)
        library, own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), byte_bpe.Ranks(registry.RANKS, pattern)
        texts = ["end. The end.\n\nit's", *strings(30, 8)]
        names, index, offsets = own.chunked(pa.array(texts))
        ids = own.chunks(names).to_pylist()
        got = [[x for i in index[a:b].tolist() for x in ids[i]] for a, b in zip(offsets, offsets[1:], strict=False)]
        assert got == [library.encode_ordinary(t) for t in texts]


def test_pieces_that_join_words_are_counted():
    scores = {c: -9.0 for c in "ab▁"} | {"▁a": -3.0, "a▁": -1.0, "a▁b": -0.5, "▁▁": -2.0, "ab": -4.0}
    own = token_counts.Transducer(scores)
    texts = ["a b", "ab a b  a", "", " ", "a a ba  b", "b a"]
    expected = [len(own._merged("▁" + t.replace(" ", "▁"))) if t else 0 for t in texts]
    assert own.counts(pa.array(texts, pa.large_string())).tolist() == expected


def test_scan_composes_maps():
    rng = np.random.default_rng(5)
    for size in (1, 2, 7):
        maps = np.vstack((np.zeros((1, size), np.int64), np.arange(size)[None], rng.integers(0, size, (6, size))))
        kinds = rng.choice(len(maps), 3000, p=[0.01, 0.49, *[0.5 / 6] * 6])
        kinds[0], state, want = 0, 0, []
        for k in kinds.tolist():
            state = int(maps[k][state])
            want.append(state)
        assert token_counts.scanned(maps, kinds).tolist() == want
    assert token_counts.scanned(np.zeros((1, 1), np.int64), np.zeros(0, np.int64)).tolist() == []


def test_runs_of_spaces_are_counted():
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    own = token_counts.transducer(registry.PIECES)
    texts = [" " * n + end for n in [*range(70), 1000, 4097] for end in ("", "a", "a" + " " * n + "b ")]
    assert own.counts(pa.array(texts, pa.large_string())).tolist() == [len(library.encode(t)) for t in texts]
    words = pa.array(["x" + " " * 300_000 + "y"], pa.large_string())
    assert own.counts(words).tolist() == [len(library.encode(words[0].as_py()))]
