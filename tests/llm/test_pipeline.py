"""The pipeline on a small table: each stage keeps the columns, drops what it should, and packs the rest."""

import collections

import corpus_pipeline
from tests.llm import brute
from tidelog.llm import minhash, mixing, packing, tokens


def test_stages(spark, docs, rows):
    df, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = corpus_pipeline.cut(stage(spark, df, ""))
        assert df.columns == docs.columns, name
        seen[name] = [r.asDict() for r in df.collect()]
    good = [r for r in seen["quality_rules"]]
    assert good and all(brute.quality(r["text"])[0] >= 50 for r in good)
    one = seen["near_dedup"]
    assert len(one) == len(set(brute.groups([(r["doc_id"], r["text"]) for r in good])))
    left = seen["suffix_dedup"]
    texts = [list(r["text"].encode()) for r in left]
    assert not any(any(g) for g in brute.repeats(texts, 200))
    taken = {(r["doc_id"], r["text"]): -(-r["taken"] // r["size"]) if r["size"] else 0 for r in mixing.take(spark.createDataFrame([tuple(x.values()) for x in left], docs.schema), "doc_id", "text").collect()}
    times = collections.Counter((r["doc_id"], r["text"]) for r in seen["source_mix"])
    assert times == {k: n for k, n in taken.items() if n} and 1 < len(set(times.values()))
    packed = corpus_pipeline.STAGES[-1][1](spark, df, "").collect()
    ids = tokens.encoder(tokens.default_vocabulary())
    want = sum(len(ids.ids(r["text"])) + 1 for r in seen["source_mix"])
    assert sum(r["length"] for r in packed) == want
    fill = collections.Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= packing.LENGTH
    pieces = collections.Counter((r["doc_id"], r["piece"]) for r in packed)
    assert {k[0]: n for k, n in pieces.items() if k[1] == 0} == collections.Counter(r["doc_id"] for r in seen["source_mix"])


def test_copies_are_no_neighbours(spark):
    df = spark.createDataFrame([(i, f"w{i} " * 10, "s", None) for i in range(40)], "doc_id long, text string, source string, lang string").coalesce(1)
    ids = [r["doc_id"] for r in mixing.mix(df).collect()]
    assert len(ids) == 60 and all(a != b for a, b in zip(ids, ids[1:]))


def test_run(spark, tmp_path):
    spark.createDataFrame([(1, "a b c " * 40, "en", "s", 240)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"


def test_near_dedup_threshold(spark):
    """Copies on both sides of 0.80: the stage keeps as many rows as brute force at 80 has groups; op7 stays at 85."""
    rows = []
    for k in range(30):
        base = [f"w{k}x{i}" for i in range(100)]
        rows.append((2 * k, " ".join(base)))
        changed = [5, 50][: 1 + k % 2] if k % 3 else [10 * i for i in range(1, 4)]
        rows.append((2 * k + 1, " ".join("new" if i in changed else w for i, w in enumerate(base))))
    sets = [brute.shingles(t) for _, t in rows]
    share = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, len(rows), 2)]
    near = {p: sum(100 * x >= p for x in share) for p in (80, 85)}
    assert 0 < near[85] < near[80] < len(share)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert corpus_pipeline.near_dedup(spark, df, "").count() == len(rows) - near[80]
    assert minhash.keep_one(df).count() == len(rows) - near[85]
    assert (1 - 0.80**minhash.ROWS) ** minhash.bands_for(80) < minhash.MISS and minhash.bands_for(85) == minhash.BANDS
