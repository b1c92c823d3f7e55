"""Operators on odd rows: nulls, empty and very long texts, ties and repeated rows, empty tables, clashing names."""

import hashlib
import time
import tracemalloc
import zlib
from collections import Counter

import re

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from tests.llm.test_contracts import component_ids
from tests.llm.conftest import LONG, ODD
from trenchbook.llm import bytework, decontaminate, fingerprint, near_dedup, packing, quality, suffix_dedup, token_count
from trenchbook.llm.chat_format import format_conversations, read_back
from trenchbook.llm.license_scan import scan_licenses
from trenchbook.llm.line_dedup import cut_repeated_lines
from trenchbook.llm.near_dedup import near_duplicates

PIECES = public_tokenizers.path("piece_bpe_32k.model")
JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{k}") for k in ("json", "tiktoken"))


def test_suffix_dedup_odd_rows(docs):
    rows = suffix_dedup.remove_repeats(docs(*ODD), 2000).collect()
    assert len(rows) == len(ODD)
    named = {r.doc_id: r for r in rows}
    assert bytes(named[3].kept).decode() == LONG
    assert bytes(named[4].kept) != b"" and bytes(named[5].kept) == b""  # both rows of 5 have a smaller twin
    assert [(s.start, s.end) for s in named[5].spans] == [(0, len(ODD[4][1].encode()))]
    assert bytes(named[None].kept).decode() == ODD[0][1] and named[1].n_bytes == named[2].n_bytes == 0
    assert suffix_dedup.remove_repeats(docs()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = ["".join(rng.choice(list("abé "), 400)), "x" * 300, "ab" * 120]
    texts = {}
    for i in range(60):
        parts = [base[rng.integers(3)][a : a + rng.integers(30, 120)] for a in rng.integers(0, 250, 4)]
        texts[int(i)] = "".join(parts) + "".join(rng.choice(list("abcdef"), rng.integers(0, 80)))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = suffix_dedup.brute_force({d: t.encode() for d, t in texts.items()})
    for size in (1000, 1 << 20):  # whatever the number of blocks
        for r in suffix_dedup.remove_repeats(frame, size).collect():
            removed = r.n_bytes - len(r.kept)
            assert (removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) == expected[r.doc_id]


def test_suffix_dedup_work_does_not_grow_with_blocks():
    """Finding repeated grams takes as long for a bucket of many blocks as for one of few, and finds the same."""
    rng = np.random.default_rng(7)
    grams = rng.integers(0, 100_000, 300_000, dtype=np.uint32)
    took, found = {}, {}
    for n in (8, 1024):
        parts = np.array_split(grams, n)
        table = pa.table({"bucket": [2] * n, "block": list(range(n)), "grams": pa.array([x.tobytes() for x in parts], pa.binary())})
        began = time.process_time()
        rows = suffix_dedup._repeated(table).to_pylist()
        took[n] = time.process_time() - began
        found[n] = set()
        for r in rows:
            kept = set(np.frombuffer(r["grams"], np.uint32).tolist())
            assert r["bucket"] == 2 and kept and kept <= set(parts[r["block"]].tolist())
            found[n] |= kept
    values, counts = np.unique(grams, return_counts=True)
    assert found[8] == found[1024] == set(values[counts > 1].tolist())
    assert took[1024] < 8 * took[8] + 0.5
    twice = np.array([5, 5, 7, 9], np.uint32)  # counted twice in its block, and once in two blocks
    table = pa.table({"bucket": [1, 1, 1], "block": [0, 1, 2], "grams": pa.array([b"", twice.tobytes(), twice[2:3].tobytes()], pa.binary())})
    got = {r["block"]: np.frombuffer(r["grams"], np.uint32).tolist() for r in suffix_dedup._repeated(table).to_pylist()}
    assert got == {1: [5, 7], 2: [7]}


def test_token_count(docs):
    rows = token_count.count_tokens(docs(*ODD, (8, " a  b "), (9, "x▁y\n")), PIECES).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = Counter((d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in [*ODD, (8, " a  b "), (9, "x▁y\n")])
    assert Counter(map(tuple, rows)) == expected
    assert token_count.count_tokens(docs(), PIECES).count() == 0


def test_near_dedup_odd_rows(docs):
    got = near_duplicates(docs(*ODD), 2).collect()
    assert len(got) == len(ODD)
    named = {r.doc_id: r for r in got}
    assert named[None].component_id is None and named[None].kept
    assert named[4].component_id == named[5].component_id == 4 and not named[5].kept
    assert named[1].n_shingles == named[2].n_shingles == named[7].n_shingles == 0 and named[7].kept
    assert named[6].n_shingles == 1
    assert near_duplicates(docs(), 2).count() == 0


def test_near_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 500, 60)
    texts = {}
    for i in range(150):  # edits of one text, so that links and near misses abound
        w = base.copy()
        w[rng.integers(0, 60, rng.integers(0, 9))] = rng.integers(0, 500)
        texts[i] = " ".join(map(str, w))
    sets = {d: set(zip(t.split(), t.split()[1:])) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(frame, 2).collect()} == {d: find(d) for d in texts}


def test_line_dedup_odd_rows(docs):
    rows = cut_repeated_lines(docs(*ODD, (10, "a\nb\nc\nd"), (11, "x\na\nb\nc\nd\n"), (11, "x\na\nb\nc\nd\n"), (12, "q\nq\nq\nq"))).collect()
    text = {r.row.doc_id: (r.row.text, r.n_lines, r.n_removed) for r in rows}
    assert len(rows) == len(ODD) + 4
    assert text[1] == (None, 0, 0) and text[2] == ("", 1, 0) and text[3][0] == LONG and text[7][0] == "   \n\n \t "
    assert text[10] == ("a\nb\nc\nd", 4, 0) and text[11] == ("x\n", 6, 4) and text[12] == ("q", 4, 3) or text[12][2] == 3
    assert cut_repeated_lines(docs()).count() == 0
    own = docs((1, "a\nb\nc"), (2, "a\nb\nc")).selectExpr("*", "7 AS n_lines", "8 AS n_removed", "9 AS lines", "10 AS gone", "11 AS doc")
    clash = {r.row.doc_id: r for r in cut_repeated_lines(own).collect()}
    assert (clash[2].row.n_lines, clash[2].row.n_removed, clash[2].row.gone, clash[2].n_lines, clash[2].n_removed) == (7, 8, 10, 3, 3)


def test_licenses(docs):
    rows = scan_licenses(
        docs(*ODD, (10, "Under the MIT license. under-the mit LICENSE"), (11, "This work was licensed under the GNU General Public Licence, License version 3"), (12, "cc by nc"))
    ).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) + 3
    assert (got[10].n_base, got[10].first_word, got[10].last_word, got[10].base_labels) == (2, 0, 4, "mit")
    assert got[11].n_base == 0 and got[11].first_word is None and got[11].base_labels == ""
    assert (got[12].base_labels, got[12].score) == ("cc-by-nc", 1.0)
    assert got[1].n_words == got[2].n_words == 0 and got[3].labels == "" and got[3].n_words == 30_000
    assert scan_licenses(docs()).count() == 0


def test_quality(spark, docs):
    good = [(i, f"the quiet river number {i} runs past the old mill and on to the sea " * 3) for i in range(0, 120, 2)]
    bad = [(i, f"BUY!! NOW!! {i}!! CHEAP!! PILLS!! CLICK!! " * 6) for i in range(1, 120, 2)]
    labels = spark.createDataFrame([(i, i % 2 == 0 and 1 or 0) for i in range(120)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(docs(*good, *bad), labels)
    scores = {r.row.doc_id: r.score for r in quality.score(docs(*good, *bad, *ODD), model).collect()}
    assert min(scores[i] for i, _ in good if i > 8) > 0.5 > max(scores[i] for i, _ in bad if i > 8)
    assert all(0 <= s <= 1 for s in scores.values()) and scores[2] > 0.3
    none = quality.train(docs(), labels)
    assert [r.score for r in quality.score(docs((1, "a")), none).collect()] == [0.5]
    assert quality.score(docs(), model).count() == 0


def test_quality_learns_from_anywhere_in_a_text(spark, docs):
    """Labels that only the text after its first 20,000 characters tells apart."""
    same = "some words that all of them begin with " * 520
    rows = [(i, same + (f"the quiet river {i} runs past the old mill " if i % 2 else f"BUY!! NOW!! {i} PILLS!! CLICK!! ") * 1500) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    scores = {r.row.doc_id: r.score for r in quality.score(docs(*rows), quality.train(docs(*rows), labels)).collect()}
    assert min(scores[i] for i in range(1, 60, 2)) > max(scores[i] for i in range(0, 60, 2))


def test_drawn_pieces(spark):
    text = "".join(f"{i:04d}" + "x" * (quality.PIECE - 4) for i in range(50)) + "end"
    frame = spark.createDataFrame([(1, text), (2, text), (3, "short"), (4, ""), (5, text[: 20 * quality.PIECE])], "draw long, text string")
    got = {r.draw: r.t for r in frame.select("draw", quality.drawn_pieces(F.col("text"), F.col("draw")).alias("t")).collect()}
    numbers = {d: [int(x) for x in re.findall(r"\d{4}", got[d])] for d in (1, 2)}
    for d in (1, 2):
        assert numbers[d] == sorted(set(numbers[d])) and len(numbers[d]) in (19, 20) and max(numbers[d]) > 20
    assert numbers[1] != numbers[2]
    assert (got[3], got[4], got[5]) == ("short", "", text[: 20 * quality.PIECE])


def test_templates_that_are_not_linked(spark):
    """Texts that share most words with all others, but with none enough; a few are near copies."""
    texts = {i: f"your order number x{i} has now been shipped to you" for i in range(700)}
    texts |= {1000 + i: f"your order number x{i} has now been shipped to you and to you" for i in range(0, 700, 50)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(frame, 2).collect()}
    assert got == component_ids(texts, 2)


def test_fingerprints(docs):
    rows = fingerprint.compare_with_next(docs(*ODD), 200).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r for r in rows}
    assert got[4].fingerprint == got[5].fingerprint and got[5].near_next == 1.0
    assert got[3].edited == LONG[: len(LONG) - len(LONG) // 3]  # the next text is empty
    assert got[None].edited.endswith("   \n\n \t ") and got[1].fingerprint == got[2].fingerprint == ""
    assert abs(got[3].n_distinct / 29_998 - 1) < 0.3
    assert fingerprint.compare_with_next(docs()).count() == 0


def test_sketches_merge():
    a, b = (" ".join(f"w{i}" for i in range(s, s + 3000)) for s in (0, 1500))
    x, y = fingerprint.sketches([a, b])
    assert np.array_equal(fingerprint.from_text(fingerprint.to_text(x)), x)
    whole = fingerprint.sketches([" ".join(f"w{i}" for i in range(4500))])[0]
    assert np.array_equal(fingerprint.merge(x, y), whole)
    assert abs(fingerprint.resemblance(x, y) - 1 / 3) < 0.15 and abs(fingerprint.containment(x, y) - 0.5) < 0.2


def test_packing(docs):
    rows = packing.pack(docs(*ODD, (9, "<|endoftext|> it's")), JSON, RANKS).collect()
    exact = Tokenizer.from_file(JSON)
    expected = Counter()
    for d, t in [*ODD, (9, "<|endoftext|> it's")]:
        ids = np.array(exact.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for s in range(0, len(ids), 1024):
            expected[d, s, len(ids[s : s + 1024]), zlib.crc32(ids[s : s + 1024].tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert sorted(used) == list(range(len(used))) and max(used.values()) <= 1024
    assert packing.pack(docs(), JSON, RANKS).count() == 0


def test_packing_is_tight():
    rng = np.random.default_rng(0)
    counts = dict(zip(*np.unique(rng.integers(1, 1025, 100_000), return_counts=True), strict=True))
    found = packing.patterns({int(k): int(v) for k, v in counts.items()})
    total = Counter()
    for pattern, n in found:
        assert sum(pattern) <= 1024
        for length in pattern:
            total[length] += n
    assert total == Counter({int(k): int(v) for k, v in counts.items()})
    assert sum(k * v for k, v in counts.items()) / (1024 * sum(n for _, n in found)) > 0.97


def test_chat_round_trip(spark):
    rows = [
        (1, 1, "assistant", "<|end|>\n <|turn|>user<|text|> \\l \\b"), (1, 0, "user", "a<b\\"), (1, 2, "assistant", ""),
        (1, 3, "assistant", "tail"), (2, None, None, None), (2, 0, "", "x"), (None, 0, "assistant", "é😀"),
        (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "we<ird\n", "\n"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in read_back(format_conversations(turns)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "a<b\\"), *[("assistant", r[3]) for r in (rows[0], rows[2], rows[3])]]
    assert got[1].loss_text == rows[0][3] + "tail" and got[1].formatted.count("<|turn|>") == 2
    assert [tuple(t) for t in got[2].turns] == [("", ""), ("", "x")] and got[None].loss_text == "é😀"
    assert [tuple(t) for t in got[3].turns] == [("user", "same")] * 2
    assert [tuple(t) for t in got[4].turns] == [("we<ird\n", "\n")]
    assert format_conversations(turns.where("conv_id = 99")).count() == 0


def test_masks_miss_no_window():
    from itertools import combinations

    def hit(width, gone):
        return any(
            all(m == "0" or s + j not in gone for j, m in enumerate(mask))
            for mask in decontaminate.MASKS
            for s in range(width - len(mask) + 1)
        )

    w, c = decontaminate.WINDOW, decontaminate.CHANGES
    assert all(hit(w, set(g)) for g in combinations(range(w), c))
    for width in range(decontaminate.ONE_CHANGE, w):
        assert all(hit(width, {g}) for g in range(width))


def test_decontaminate(spark, docs):
    item = " ".join(f"q{i}" for i in range(30))
    changed = item.replace("q3 ", "zz ").replace("q8 ", "zz ").replace("q14 ", "zz ")
    half = " ".join(f"q{i}" for i in range(8, 21))
    every_third = " ".join("zz" if i % 3 == 0 else f"q{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, item), (4, "short one here"), (4, "short one here")], "item_id long, text string")
    rows = decontaminate.find_leaks(docs(*ODD, (10, "a " + changed.upper()), (11, "b " + half), (12, every_third), (13, "so short one, here")), bench, 150).collect()
    got = {r.row.doc_id: sorted({s.item_id for s in r.spans}) for r in rows}
    assert len(rows) == len(ODD) + 4
    assert got[10] == [1] and got[11] == [1] and got[12] == [] and got[13] == [4]
    assert all(not got[d] for d, _ in ODD)
    assert decontaminate.find_leaks(docs((1, item)), bench.limit(0)).first().spans == []
    assert decontaminate.find_leaks(docs(), bench).count() == 0


def test_near_duplicates_hold_little_of_a_batch():
    """Words and shingles of 8 MB of texts are made in small slices."""
    texts = pa.array([" ".join(f"w{(i * 131 + j * j) % 5003}" for j in range(1200)) for i in range(1300)])
    bytework._powers = bytework._inverse = np.ones(1, np.uint64)
    assert texts.nbytes > 6_000_000
    tracemalloc.start()
    n = sum(len(offsets) - 1 for _, offsets in near_dedup.document_shingles(texts, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and peak < 60_000_000, peak
