"""The pipeline against plain versions of its stages, and the registration of its query."""

import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline

from .test_documents import LOWER, plain_spans, words

BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_equals_plain_stages(spark, docs, texts, tmp_path):
    docs.select(*BASE).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = texts[10]
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    # one label class: all stay; then one document of each class, linked by brute force
    sets = {i: frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w := words(t)) >= 5 else frozenset([tuple(w)] if w else []) for i, t in rows if i is not None}
    top = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) > 0:
                    top[i] = top[j] = min(top[i], top[j])
    norm = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate(LOWER))) + " "
    kept = {(i, t) for i, t in rows if i is not None and top[i] == i and norm(item) not in norm(t)}
    assert sum(norm(item) in norm(t) for _, t in rows) >= 1
    kept = list(kept) + [(i, t) for i, t in rows if i is None]

    def clean(t):
        spans = sorted([(a, b, k) for k, a, b in plain_spans(t or "")] + [(m.start(), m.end(), "identifier") for m in re.finditer(r"(?<=token = \")[0-9a-f]{40}", t or "")])
        out, at = "", 0
        for a, b, k in spans:
            out, at = out + (t[at:a] + f"<{k.upper()}>" if a >= at else ""), max(at, b)
        return out + (t or "")[at:]

    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tok.encode_special_tokens = True
    want = []
    for i, t in kept:
        ids = tok.encode(clean(t), add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(want, key=str)


def test_stages_keep_the_columns(spark, docs, tmp_path):
    table = docs.select(*BASE)
    spark.createDataFrame([(100, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a benchmark text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, str(tmp_path))
        assert out.dtypes == table.dtypes, name


def test_eleven_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [k for k in range(1, 11) if sum(n.startswith(f"op{k}_") for n in names) != 1] == []
    assert len(corpus_pipeline.STAGES) == 5
