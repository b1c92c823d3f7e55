"""Registered queries over whole small tables against plain Python that tries everything."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from trenchbook.llm import decontaminate, quality, suffix_dedup
from trenchbook.llm.license_scan import PHRASES
from trenchbook.llm.queries import GOOD, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="module")
def benchmark(spark):
    return {r.item_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}


def answer(spark, name) -> dict:
    rows = QUERIES[name](spark, SF_DIR).collect()
    found = {r[0]: r for r in rows}
    assert len(found) == len(rows)
    return found


def words(text: str, kind: str = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") -> list[str]:
    return re.findall(kind, text.translate(LOWER))


def shingle_sets(texts: dict, width: int) -> dict:
    sets = {}
    for d, t in texts.items():
        w = words(t, r"[^\x20\x09-\x0D]+")
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    return sets


def component_ids(texts: dict, width: int) -> dict:
    sets, root = shingle_sets(texts, width), {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(d for d in texts if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in texts}


def leaked(text: str, items: dict) -> list[int]:
    """Items of which a window stands in the text, by every diagonal that holds an equal word."""
    own, places, out = words(text), defaultdict(list), []
    for i, w in enumerate(own):
        places[w].append(i)
    for item, asked in items.items():
        m = words(asked)
        span = min(decontaminate.WINDOW, len(m))
        if not m:
            continue
        changes = decontaminate.CHANGES if span == decontaminate.WINDOW else span // decontaminate.ONE_CHANGE
        votes = Counter(p - j for j, w in enumerate(m) for p in places.get(w, ()))
        for shift in [s for s, n in votes.items() if n >= span - changes]:
            low, high = max(0, -shift), min(len(m), len(own) - shift)
            equal = [own[j + shift] == m[j] for j in range(low, high)]
            if any(sum(equal[s : s + span]) >= span - changes for s in range(len(equal) - span + 1)):
                out.append(item)
                break
    return sorted(out)


def check_pieces(rows, texts: dict) -> None:
    """Every id in exactly one piece, sequences gapless and short enough."""
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        ids, at = np.array(exact.encode(texts[d], add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_suffix_dedup(spark, texts):
    got = answer(spark, "op1_suffix_dedup")
    expected = suffix_dedup.brute_force({d: t.encode() for d, t in texts.items()})
    assert {d: (r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == expected


def test_token_count(spark, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = answer(spark, "op2_token_count")
    for d, t in texts.items():
        n = len(model.encode(t))
        assert (got[d].n_bytes, got[d].n_tokens, got[d].over_limit) == (len(t.encode()), n, n > 4096)


def test_near_dedup(spark, texts):
    got = answer(spark, "op3_near_dedup")
    sets, roots = shingle_sets(texts, 2), component_ids(texts, 2)
    assert {d: tuple(r)[1:] for d, r in got.items()} == {d: (len(sets[d]), roots[d], roots[d] == d) for d in texts}


def test_license_scan(spark, texts):
    got = answer(spark, "op5_license_scan")
    for d, t in texts.items():
        w, places, labels = words(t), [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[d]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_quality_score(spark, texts):
    got = answer(spark, "op6_quality_score")
    assert set(got) == set(texts)
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= GOOD)

@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_quality_on_held_out_labels(spark):
    """On the larger table: the smallest one has three bad held-out documents and eight to learn from."""
    got = {r.doc_id: r for r in QUERIES["op6_quality_score"](spark, LARGER).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    good, bad = ([got[d].score for d, q in labels.items() if d in got and got[d].held_out and q == k] for k in (1, 0))
    better = [(g > b) + (g == b) / 2 for g in good for b in bad]
    assert len(bad) > 10 and sum(better) >= 0.95 * len(better)


def test_fingerprint(spark, texts):
    got, ids = answer(spark, "op7_fingerprint"), sorted(texts, reverse=True)
    prints = {}
    for d, other in zip(ids, ids[1:] + ids[:1], strict=True):
        t, n = texts[d], len(texts[d]) // 3
        edited = t[: len(t) - n] + texts[other][:n]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        a, b = (shingle_sets({0: x}, 3)[0] for x in (t, texts[other]))
        if a and b:
            assert abs(r.near_next - len(a & b) / len(a | b)) < 0.25


def test_packing(spark, texts):
    check_pieces(QUERIES["op8_packing"](spark, SF_DIR).collect(), texts)


def test_chat_format(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()
    said, talks = "\\### Assistant: </turn> ok", defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn)):
        talks[r.conv_id].append((r.role, r.text or ""))
    talks[-7] = [("user", said), ("assistant", said)]
    got = answer(spark, "op9_chat_format")
    assert set(got) == set(talks)
    for c, turns in talks.items():
        spoken = "".join(t for role, t in turns if role == "assistant")
        told = "".join(f"{role}\n{t}\n" for role, t in turns)
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha(told))
        assert (r.loss_chars, r.loss_sha256) == (len(spoken), sha(spoken))
        assert r.formatted_chars >= len("".join(t for _, t in turns))


def test_decontaminate(spark, texts, benchmark):
    got = answer(spark, "op10_decontaminate")
    assert {d: (r.n_words, r.item_ids) for d, r in got.items()} == {
        d: (len(words(t)), leaked(t, benchmark)) for d, t in texts.items()
    }


def test_few_hits_at_a_time_find_the_same(spark, texts, benchmark, monkeypatch):
    ids = list(benchmark)
    items = decontaminate.prepare(ids, [benchmark[i] for i in ids])
    rng = np.random.default_rng(0)
    hashes = rng.choice(items.words, 4000)  # made of the items' words, so that seeds meet often
    hashes[100:140] = items.words[:40]
    hashes[3000:3200] = items.words[0]
    text, first = np.repeat([0, 1], 2000), np.array([0, 2000, 4000])
    found = decontaminate.overlaps(hashes, text, first, items)
    monkeypatch.setattr(decontaminate, "PAIRS", 3)
    assert found and decontaminate.overlaps(hashes, text, first, items) == found


def test_one_doc_id_on_many_rows_leaves_the_model_as_it_is(spark, docs):
    rows = [(i, f"{'calm river' if i % 2 else 'BUY!! NOW!!'} {i} " * 20) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    hot = [(7, f"copy {i}") for i in range(500)]
    without = quality.train(docs(*[r for r in rows if r[0] != 7]), labels)
    assert quality.train(docs(*rows, *hot), labels) == without


def test_pipeline(spark, texts, benchmark):
    model = quality.train(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    )
    ids = sorted(texts)
    x = quality.differences([texts[d] for d in ids], model.good, model.bad, model.usual)
    score = 1 / (1 + np.exp(-np.clip(model.slope * (x - model.middle), -30, 30)))
    left = {d: texts[d] for d, s in zip(ids, score, strict=True) if s >= GOOD}
    assert 0 < len(left) < len(texts)

    seen, cut = set(), {}
    for d in sorted(left):
        lines, gone = left[d].split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if all(not line.strip(" ") for line in window):
                continue
            if window in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(window)
        text = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        if not gone or text.strip(" "):
            cut[d] = text
    assert any(cut[d] != left[d] for d in cut)

    roots = component_ids(cut, 5)
    apart = {d: t for d, t in cut.items() if roots[d] == d}
    clean = {d: t for d, t in apart.items() if not leaked(t, benchmark)}
    assert len(clean) < len(apart) < len(cut)
    check_pieces(corpus_pipeline.run(spark, SF_DIR).collect(), clean)
