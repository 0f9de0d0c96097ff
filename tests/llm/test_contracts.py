"""The registered queries of the ten operators on the smallest tables, against plain versions of what their columns mean."""

import collections
import hashlib
import math
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidebook.llm import decontaminate, pii, queries, toxic_crf

from .test_documents import LOWER, plain_spans, words

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
SPACED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def table():
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(table):
    return {i: t or "" for i, t in table.execute("select doc_id, text from documents").fetchall()}


def run(spark, name):
    rows = queries.queries()[name](spark, DIR).collect()
    return rows, {r["doc_id"]: r for r in rows}


def remainder(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def test_op1(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tok.encode_special_tokens = True
    rows, _ = run(spark, "op1_best_two_fit_packing")
    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts.items():
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(got[i])
        assert [p[0] for p in parts] == list(range(len(parts))) and sum(p[2] for p in parts) == len(ids)
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for _, a, n, c in parts) and (len(parts) == 1 or all(n == 2048 for _, _, n, _ in parts[1:]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1


def test_op2(spark, texts):
    rows, _ = run(spark, "op2_gear_chunk_dedup")
    flat = lambda t: " ".join(t.translate(LOWER).split())
    for r in rows:
        assert r["first_doc_id"] <= r["doc_id"] and r["keeps"] == (r["doc_id"] == r["first_doc_id"]) and flat(texts[r["doc_id"]][r["start"] : r["stop"]]) in flat(texts[r["first_doc_id"]])
    grams = collections.defaultdict(set)
    for i, t in texts.items():
        w = words(t)
        for k in range(len(w) - 59):
            grams[tuple(w[k : k + 60])].add(i)
    shared = {i for s in grams.values() if len(s) > 1 for i in s}
    assert len(shared & {r["doc_id"] for r in rows}) >= 0.98 * len(shared)


def test_op3(spark, texts):
    rows, got = run(spark, "op3_cotrained_quality")
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= 0.1) for r in rows)


def test_op4(spark, table, texts):
    """Every item against every text by the alignment alone: no filter, no bands."""
    items = table.execute("select item_id, text from benchmark where text is not null").fetchall()
    rows, _ = run(spark, "op4_qgram_decontamination")
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    norm = lambda t: re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", t.translate(LOWER)).strip().encode()
    want = set()
    plain = {i: norm(t) for i, t in texts.items() if len(t) < 20_000}
    for item_id, text in items:
        one = decontaminate.index([(item_id, text)])
        if not one.texts:
            continue
        item, budget = norm(text), one.budget(0)
        seeds = [item[k : k + 8] for k in range(0, len(item) - 8, max(8, len(item) // (2 * budget + 2)))]  # an occurrence within the budget holds one of them
        for i, t in plain.items():
            if any(s in t for s in seeds) and decontaminate.edits(item, t, -len(item), len(t), budget)[0] <= budget:
                want.add((i, item_id))
    assert {(d, k) for d, k in got if d in plain} == want and want


def test_op5(spark, table):
    rows, _ = run(spark, "op5_chosen_path_near_dedup")
    want = table.execute(queries.oracle_sql()["op5_chosen_path_near_dedup"]).fetchall()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows) == sorted(want)


def test_op6(spark, texts):
    rows, got = run(spark, "op6_license_scan")
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for i, t in texts.items():
        w = SPACED.findall(t.translate(LOWER))
        places = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        labels, r = sorted({x for _, x in places}), got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(labels) <= set(r["labels"].split(",")) and r["labels"].split(",") == sorted(set(r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert len(rows) == len(texts)


def test_op7(spark, texts):
    rows, got = run(spark, "op7_merkle_fingerprints")
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        t, follow = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (got[i]["fingerprint"] == got[i]["edited_fingerprint"]) == (t == edited) and 0 <= got[i]["near_next"] <= 1 and 0 <= got[i]["near_edited"] <= 1
    by_text = collections.defaultdict(set)
    for i, t in texts.items():
        by_text[t].add(got[i]["fingerprint"])
    assert len(rows) == len(texts) and all(len(v) == 1 for v in by_text.values())


def test_op8(spark, texts):
    rows, got = run(spark, "op8_kneser_ney_scores")
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    count = collections.Counter(w for i, ws in tokens.items() if remainder(i, 5) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (remainder(i, 5) == 1, len(ws), sum(w in count for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(texts) and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op9(spark, texts):
    rows, got = run(spark, "op9_crf_toxicity")
    assert len(rows) == len(texts)
    for i, r in got.items():
        assert r["held_out"] == (remainder(i, 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert all(0 <= int(a) < int(b) <= len(texts[i]) for a, b in (x.split(":") for x in r["toxic_spans"].split(",") if x))


def test_scores_equal_plain_loops():
    """Scores and spans of texts together against loops over each text's marginals alone."""
    from tidebook.llm import _shared

    r = np.random.default_rng(3)
    model = toxic_crf.Model(r.normal(size=1 << toxic_crf.BITS).astype(np.float32), r.normal(size=(2, 2)), r.normal(size=2), r.normal(size=4))
    texts = ["some plain words here", "", "one", "Ünïcode ends, and MORE words of text " * 40, "  "]
    score, spans = toxic_crf.score_texts(pa.array(texts), model)
    for k, text in enumerate(texts):
        _, _, at, hashes = toxic_crf.tokens(*_shared.text_bytes(pa.array([text])))
        first = np.arange(hashes.shape[1]) == 0
        p = toxic_crf.marginals(toxic_crf.features(hashes, first), first, model).tolist() if hashes.shape[1] else []
        most = min(max(max(p, default=0.0), 1e-6), 1 - 1e-6)
        x = [1.0, math.log(most / (1 - most)) / 10, math.log(sum(p) + 1e-3), math.log((sum(p) + 1e-3) / (len(p) + 10))]
        assert score[k] == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.calibration)))), rel=1e-4)
        found = re.findall(r"[^\x00-\x26\x28-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
        assert [text[s["start"] : s["end"]] for s in spans[k]] == [w for w, q in zip(found, p, strict=True) if q >= 0.5]


def test_op10(spark, texts):
    rows, got = run(spark, "op10_bootstrapped_pii")
    for i, t in texts.items():
        base = sorted(plain_spans(t), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        joined, r = ",".join(f"{k}:{a}:{b}" for k, a, b in base), got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and r["spans"].startswith(joined)
    assert len(rows) == len(texts)
