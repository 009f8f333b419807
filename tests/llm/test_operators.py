"""Each operator against a plain version, over a table that holds every odd case, and over an empty one."""

import collections
import random
import zlib

import numpy as np
import pytest
from tests.llm import brute

from tidelog.llm import block_repeats, fingerprints, html_text, licenses, minhash, mixing, packing, quality, suffix_repeats, tokens


def multiset(rows):
    return collections.Counter(rows)


def got(df, *columns):
    return multiset(tuple(r[c] for c in columns) for r in df.collect())


def test_tokens(docs, rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        e = plain.encode(text or "", add_special_tokens=False)
        ends = np.cumsum([len(x) + 1 for x in (text or "").split("\n")])
        ends[-1] -= 1
        starts = np.append(0, ends[:-1])
        n, across = [0] * len(ends), [0] * len(ends)
        for a, b in e.offsets:
            share = [min(b, y) - max(a, x) for x, y in zip(starts, ends)]
            k = int(np.argmax(share))
            n[k] += 1
            across[k] += a < starts[k] or b > ends[k]
        want.update((doc_id, k, int(starts[k]), int(ends[k]), n[k], across[k]) for k in range(len(ends)))
    assert got(tokens.attribute(docs), "doc_id", "section", "start", "end", "n_tokens", "n_crossing") == want


def test_given_sections(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "hello world again", [(0, 8), (12, 17)]), (2, "abc", None)], "doc_id long, text string, s array<struct<start:long,end:long>>")
    found = {(r["doc_id"], r["section"]): (r["n_tokens"], r["n_crossing"]) for r in tokens.attribute(df, F.col("s")).collect()}
    # " world" has 2 of its characters in the first section and none in the second
    assert found == {(1, 0): (2, 1), (1, 1): (1, 1), (2, -1): (1, 0)}


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("hot", [2, 2000])
def test_suffix_repeats(docs, rows, keep_first, hot):
    order = sorted({(r[0] if r[0] is not None else 1 << 63, r[1] or "") for r in rows}) if keep_first else [(r[0], r[1] or "") for r in rows]
    if keep_first:  # ties in doc_id follow the digest
        import hashlib

        order = sorted(order, key=lambda x: (x[0], hashlib.md5(x[1].encode()).digest()))
    gone = brute.repeats([list(t.encode()) for _, t in order], 200, keep_first)
    want = {}
    for (doc_id, t), g in zip(order, gone):
        left = bytes(b for b, x in zip(t.encode(), g) if not x)
        spans = sum(x and not y for x, y in zip(g, [False, *g]))
        want[(None if doc_id == 1 << 63 else doc_id, t)] = (len(g), sum(g), spans, brute.sha(left))
    found = suffix_repeats.remove(docs, "doc_id", keep_first=keep_first, hot=hot)
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == multiset((r[0], *want[(r[0], r[1] or "")]) for r in rows)


def test_longest_previous_factors():
    data = np.frombuffer(b"mississippi mississippi mission" + b" " * 16, np.uint8)
    n = len(data) - 16
    starts = np.arange(n)
    order, lcp = suffix_repeats.suffix_order(data, starts, starts, 16)
    text = data.tobytes()
    keys = [(text[i : i + 16], i) for i in order]
    assert keys == sorted(keys)
    found = np.zeros(n, int)
    found[order] = suffix_repeats.previous_factor(order, lcp, 1)
    for i in range(n):
        best = max((next(k for k in range(17) if k == 16 or text[i + k] != text[j + k]) for j in range(i)), default=0)
        assert found[i] == best


def test_licenses(docs, rows):
    found = licenses.scan(docs)
    assert got(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == multiset((r[0], *brute.licenses(r[1])) for r in rows)
    labels = {r["labels"] for r in found.collect()}
    assert {"", "mit,mit-notice", "apache,apache-2.0,gpl"} <= labels and all(0 <= r["score"] <= 1 for r in found.collect())


def longest_path(words, template):
    """Share of the template's pairs in the longest run of hits, by trying all steps."""
    t = list(zip(template, template[1:]))
    hits = [(i, k) for i, p in enumerate(zip(words, words[1:])) for k, q in enumerate(t) if p == q]
    best = {}
    for i, k in hits:
        best[i, k] = 1 + max((n for (j, m), n in best.items() if j < i and m < k and abs(i - j - k + m) <= licenses.DRIFT), default=0)
    return max(best.values(), default=0) / len(t)


def test_license_labels_equal_longest_paths(spark):
    """Texts of shuffled, repeated, dropped and inserted template words."""
    r, rows, want = random.Random(8), [], {}
    for i in range(120):
        template = r.choice(licenses.NOTICES)[0].split()
        ws = [r.choice(["a", "of", "the", "free"]) for _ in range(r.randint(0, 6))]
        for w in template * r.randint(1, 2):
            x = r.random()
            ws += [] if x < 0.03 else [w, r.choice(["very", "of", "the"])] if x < 0.06 else [w]
        if r.random() < 0.2:
            r.shuffle(ws)
        if r.random() < 0.3:
            ws *= 3
        rows.append((i, " ".join(ws)))
        found = {}
        for phrase, label in licenses.NOTICES:
            t = phrase.split()
            score = longest_path(ws, t)
            if score >= (1 if len(t) - 1 < licenses.LONG else licenses.ACCEPT):
                found[label] = max(score, found.get(label, 0))
        base = {label for p, label in licenses.BASE for k in range(len(ws)) if ws[k : k + len(p.split())] == p.split()}
        want[i] = (",".join(sorted({*found, *base})), 1.0 if base else max(found.values(), default=0.0))
    assert 20 < sum(bool(x) for x, _ in want.values()) < 120
    got_ = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got_.keys() == want.keys() and all(got_[i][0] == want[i][0] and got_[i][1] == pytest.approx(want[i][1]) for i in want)


def test_repeated_phrases_are_no_license(spark):
    texts = ["parking is free " + "of charge " * 16, "to any to any " * 20, "free of charge to any person " * 40, "copies of the terms under the license of the software " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r["labels"], r["score"]) for r in licenses.scan(df).collect()} == {("", 0.0)}


def test_license_with_inserted_words(spark):
    text = "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this fine software and associated documentation files"
    df = spark.createDataFrame([(1, text), (2, "permission is granted")], "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(df).collect()}
    assert found[1][0] == "mit-notice" and 0.8 <= found[1][1] < 1 and found[2] == ("", 0.0)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>menu</a></ul></nav><div class="cookie-notice">We use cookies on this site.</div>
<div id=main-column><div class=post><h2>Title &eacute; &amp; more</h2><p>First paragraph&nbsp;with <b>bold</b>
 text<br>and a break.<p>Second one, <a href=/x>linked</a>, long enough to count as text of the page.<ul><li>item one<li>item two</ul>
<form><input value=q>search</form><div class="ad">Buy this now</div></div></div>
<aside><p>Aside text that is long enough to be taken for content by mistake</p></aside><section id="comments"><p>First! I have a lot to say about this.</p></section><footer>&copy; foot</footer></body></html>"""


def test_html(spark):
    want = "Title é & more\nFirst paragraph with bold text and a break.\nSecond one, linked, long enough to count as text of the page.\nitem one\nitem two"
    assert html_text.main_text(PAGE) == want
    odd = [None, "", "plain", "<p>a", "<" * 500, "<a \"" * 500, "<div>" * 3000 + "deep", "<script>x", "<!-- x", PAGE[:700]]
    rows = [(i, None if i % 2 else "u", h) for i, h in enumerate([PAGE, *odd, PAGE])]
    found = {r["page_id"]: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[0]["text"] == found[11]["text"] == want and found[1]["text"] == found[2]["text"] == "" and found[3]["text"] == "plain" and found[4]["text"] == "a"
    assert found[7]["text"] == "deep" and all(r["n_chars"] == len(r["text"]) for r in found.values())


@pytest.mark.parametrize("page, text", [
    ('<body><div class="content has-sidebar"><p>All of the text there is.</p></div>', "All of the text there is."),
    ('<body><div class="sidebar"><p>All of the text there is.</p></div>', "All of the text there is."),
    ('<article><header class="entry-header"><h1>Title</h1></header><p>Body text of it.</p><footer>tags</footer></article>', "Title\nBody text of it."),
    ('<body><header><p>Site name</p></header><div class="page-header">Slogan</div><main><p>Body text of it.</p></main>', "Body text of it."),
    ('<body><article><p>One, a first part.</p><div role=alert>note</div><p>Two, a second&nbsp; part.</p></article><article class="comment"><p>me too</p></article>', "One, a first part.\nTwo, a second part."),
])
def test_html_blocks(page, text):
    assert html_text.main_text(page) == text


def test_html_siblings_under_body():
    """Text in two blocks directly under body: both stay; a list of links beside them goes."""
    part = lambda k: "<div>" + "".join(f"<p>Paragraph {k}{i} says enough in plain words to be taken for content, as its neighbours do.</p>" for i in range(5)) + "</div>"
    links = "<div>" + "".join(f"<a href='{i}'>Another page {i}</a> " for i in range(6)) + "</div>"
    text = html_text.main_text(f"<html><body>{part(1)}{part(2)}{links}</body></html>")
    assert text.count("Paragraph 1") == 5 and text.count("Paragraph 2") == 5 and "Another" not in text


def test_quality(docs, rows):
    found = quality.score(docs)
    want = []
    for r in rows:
        q = brute.quality(r[1])
        want.append((r[0], *q, q[0] < 50 or 100 * q[4] > 50 * q[0]))
    assert got(found, "doc_id", *quality.COUNTS, "base_failed") == multiset(want)
    assert not any(r["kept"] and r["base_failed"] for r in found.collect())
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == found.filter("kept").count()


def test_quality_fences_are_native_and_adapt(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 997}" for k in range(100)), "en", "a") for i in range(60)]
    rows += [(100 + i, " ".join(f"w{k}%%%" for k in range(i, i + 100)), "en", "a") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = quality.score(df)
    assert {r["doc_id"] for r in found.filter("not kept").collect()} == set(range(100, 105))
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_quality_fences_equal_plain_quantiles(spark):
    """Whole verdicts against exact quantiles of the same steps, for groups above and below min_rows."""
    r, rows = random.Random(6), []
    for i in range(900):
        lang, source = r.choice([("en", "a"), ("en", "b"), ("en", None), ("fr", "a"), ("de", "z")][: 4 + (i % 300 == 0)])
        odd = r.random() < 0.08
        ws = [f"w{r.randint(0, 99 if odd else 10**6)}" + ("%#" if odd and r.random() < 0.5 or source == "b" and k % 9 == 0 else "") for k in range(r.randint(40, 120))]
        rows.append((i, "\n".join(" ".join(ws[k : k + 10]) for k in range(0, len(ws), 10)), lang, source))
    steps = {}
    for i, text, lang, source in rows:
        n, chars, symbols, dup, repeat = brute.quality(text)
        lines = len([x for x in text.split("\n") if x.strip()])
        if n >= 50 and 100 * repeat <= 50 * n:
            steps[i] = {"symbol_rate": symbols * 10_000 // chars, "dup_line_rate": dup * 10_000 // lines, "repeat_rate": repeat * 10_000 // n, "word_length": chars * 100 // n}

    def fence(name, ids):
        xs = sorted(steps[i][name] for i in ids)
        q1, q3 = xs[-(-len(xs) // 4) - 1], xs[-(-3 * len(xs) // 4) - 1]
        return q3 + max(quality.SPREADS * (q3 - q1), round(quality.LEAST[name] * quality.STEPS[name]))

    good = set()
    for i, _, lang, source in rows:
        if i not in steps:
            continue
        own, same = [k for k in steps if rows[k][2:] == (lang, source)], [k for k in steps if rows[k][2] == lang]
        ok = True
        for name in quality.LEAST:
            above = fence(name, same if len(same) >= quality.MIN_ROWS else steps)
            mine = min(fence(name, own), above + round(quality.LEAST[name] * quality.STEPS[name])) if len(own) >= quality.MIN_ROWS else above
            ok &= steps[i][name] <= mine
        if ok:
            good.add(i)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r["doc_id"] for r in quality.score(df).filter("kept").collect()} == good and 0 < len(steps) - len(good) < 200


def test_quality_reruns_agree(spark):
    """100,000 rows of one source, read in two orders: one verdict."""
    from pyspark.sql import functions as F

    n = F.col("id") % 57
    rows = spark.range(100_000).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), F.xxhash64("id", k).cast("string"), F.repeat(F.lit("%"), F.when(k < n, 2).otherwise(0)))), " ").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    one = quality.score(rows).filter("kept").agg(F.count("*"), F.sum("doc_id")).first()
    two = quality.score(rows.repartition(7, F.xxhash64("doc_id"))).filter("kept").agg(F.count("*"), F.sum("doc_id")).first()
    assert one == two and 0 < one[0] <= 100_000


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    found = packing.pack(docs).collect()
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((doc_id, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert multiset((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    bins = collections.defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.parametrize("ahead, open_bins", [(1, 4), (16, 4), (1024, 256)])
def test_packing_is_best_fit(spark, ahead, open_bins):
    """Bins and offsets against a list of open bins searched one by one."""
    r = random.Random(12)
    rows = [(i, "word " * r.randint(0, 150)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = packing.pack(df, length=128, open_bins=open_bins, ahead=ahead).collect()
    size = lambda k: found[k]["length"]
    open_, made, bins, step = [], 0, {}, 0
    order = range(len(found))
    if ahead > 1:  # 400 short texts are one slice: the largest first
        order = sorted(order, key=lambda k: (-size(k), k))
    for k in order:
        fits = [b for b in open_ if b[0] >= size(k)]
        if fits:
            b = min(fits, key=lambda b: (b[0], -b[2]))
        else:
            if len(open_) >= open_bins:
                fullest = min(open_, key=lambda b: (b[0], -b[2]))
                open_.remove(fullest)
            b = [128, made, 0]
            made += 1
            open_.append(b)
        bins[k] = (b[1], 128 - b[0])
        b[0] -= size(k)
        step += 1
        b[2] = step
        if not b[0]:
            open_.remove(b)
    assert [(x["sequence_id"], x["offset"]) for x in found] == [bins[k] for k in range(len(found))]


def test_packing_is_near_the_bound(spark):
    r = random.Random(13)
    df = spark.createDataFrame([(i, "word " * int(r.lognormvariate(6, 1))) for i in range(3000)], "doc_id long, text string").coalesce(1)
    found = packing.pack(df).collect()
    assert len({x["sequence_id"] for x in found}) <= 1.01 * -(-sum(x["length"] for x in found) // packing.LENGTH)


def test_open_bins_of_many_tasks_are_packed_together(spark):
    """Hardly more sequences in 64 tasks than in one, each without a gap."""
    r = random.Random(14)
    df = spark.createDataFrame([(i, "word " * int(r.lognormvariate(6, 1))) for i in range(2000)], "doc_id long, text string")
    for tasks in (1, 64):
        found, bins = packing.pack(df.repartition(tasks)).collect(), collections.defaultdict(list)
        for x in found:
            bins[x["sequence_id"]].append((x["offset"], x["length"]))
        for parts in bins.values():
            ends = np.cumsum([n for _, n in sorted(parts)])
            assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= packing.LENGTH
        assert len(bins) <= 1.02 * -(-sum(x["length"] for x in found) // packing.LENGTH)


def test_very_long_blanks(spark):
    """Runs of millions of blanks or line feeds, alone and inside a text: ids as the plain tokenizer gives them, through both operators."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    texts = [" " * 3_000_000, "\n" * 3_000_000, "a b" + " " * 1_500_000 + "don't stop\n", "x" + "\n" * 1_200_000 + " y\u3000", "\t\u2003" * 5000 + "z" + " " * 4096 + "\nq"]
    code = tokens.encoder(tokens.default_vocabulary())
    for text in texts:
        e = plain.encode(text, add_special_tokens=False)
        ids = code.ids(text)
        assert np.array_equal(ids, np.array(e.ids, np.uint32))
        first, last = code.spans(ids)
        assert np.array_equal(np.stack([first, last], 1), np.array(e.offsets))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    sizes = {i: len(plain.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    packed = collections.Counter()
    for x in packing.pack(df).collect():
        packed[x["doc_id"]] += x["length"]
    assert packed == {i: n + 1 for i, n in sizes.items()}
    counted = tokens.attribute(df).groupBy("doc_id").agg({"n_tokens": "sum"}).collect()
    assert {x[0]: x[1] for x in counted} == sizes


def test_sections_that_overlap(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "one two three four", [(8, 13), (0, 7), (4, 10), (5, 6), (None, 3), None])], "doc_id long, text string, s array<struct<start:long,end:long>>")
    found = [(r["section"], r["start"], r["end"], r["n_tokens"]) for r in tokens.attribute(df, F.col("s")).orderBy("section").collect()]
    # (4, 10) has 7 to 10 of its own, (8, 13) then 10 to 13; " three", 7 to 13, is a tie of the two
    assert found == [(-1, None, None, 1), (0, 0, 7, 2), (1, 4, 10, 1), (2, 5, 6, 0), (3, 8, 13, 0)]


def test_packer_closes_the_fullest():
    p = packing.Packer(10, 2, 0)
    assert [p.place(s) for s in (8, 5, 5, 9, 6, 2, 4)] == [(0, 0), (1, 0), (1, 5), (2, 0), (3, 0), (0, 8), (3, 6)]


def test_encoder_equals_tokenizers():
    import random

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_vocabulary())
    plain.encode_special_tokens = True
    mine, r = tokens.encoder(tokens.default_vocabulary()), random.Random(2)
    letters = [*"abc XYZ  \n\t\r'  \x1c\x85éßñ日本語😀👍🏽0123½²٣.,!?<|>#_-", "<|endoftext|>", "'s", "   "]
    for _ in range(800):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 50)))
        e = plain.encode(text, add_special_tokens=False)
        ids = mine.ids(text)
        assert ids.tolist() == e.ids and list(zip(*(x.tolist() for x in mine.spans(ids)))) == e.offsets


def test_near_duplicates(docs, rows):
    label = brute.components([(r[0], r[1]) for r in rows])
    want = multiset((r[0], len(brute.shingles(r[1])), label[i], r[0] == label[i]) for i, r in enumerate(rows))
    assert got(minhash.classes(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    one = minhash.keep_one(docs)
    texts = [r["text"] for r in one.collect()]
    assert one.columns == docs.columns and sum(not brute.shingles(t) for t in texts) == sum(not brute.shingles(r[1]) for r in rows)
    full = [t for t in texts if brute.shingles(t)]
    number = brute.groups([(r[0], r[1]) for r in rows])
    assert len(full) == len({number[i] for i, r in enumerate(rows) if brute.shingles(r[1])})


@pytest.mark.parametrize("meet", [2, 1024])
def test_near_duplicates_in_blocks(spark, monkeypatch, meet):
    """A group without a hub, in blocks of four: chains of edits, no document like all others; a hub's pairs in parts of two."""
    import random

    monkeypatch.setattr(minhash, "MEET", meet)
    r = random.Random(11)
    text = [f"w{r.randint(0, 10**6)}" for _ in range(300)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(text)))
        for _ in range(r.choice([1, 2, 4, 9])):
            text[r.randrange(300)] = f"e{r.randint(0, 10**6)}"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(df, "doc_id", block=4).collect()}
    assert found == brute.components(rows)


def test_components_both_ways(spark):
    import random

    from tidelog.llm.components import components

    r = random.Random(4)
    edges = [(i, i + 1) for i in range(30)] + [(100 + r.randrange(30), 100 + r.randrange(30)) for _ in range(20)]
    df = spark.createDataFrame([(str(a).zfill(4).encode(), str(b).zfill(4).encode()) for a, b in edges], "a binary, b binary")
    one, many = ({bytes(x["node"]): bytes(x["label"]) for x in components(df, small).collect()} for small in (1000, 0))
    assert one == many and set(one[str(i).zfill(4).encode()] for i in range(31)) == {b"0000"}


def test_mixing(docs, rows):
    found = [r.asDict() for r in mixing.take(docs, "doc_id", "source").collect()]
    size = lambda t: len(brute.WORD.findall(t or ""))
    assert multiset((r["doc_id"], r["size"]) for r in found) == multiset((r[0], size(r[1])) for r in rows)
    total = collections.Counter()
    for _, t, _, s in rows:
        total[s] += size(t)
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, pool = dict(weight), {}, 1.5 * sum(total.values())
    while True:  # share by weight, stop what is above its cap, share again
        give = {s: pool * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if give[s] > 2 * total[s]]
        if not over:
            target |= give
            break
        for s in over:
            target[s] = 2 * total[s]
            pool -= 2 * total[s]
            del left[s]
    taken = collections.Counter()
    for r in found:
        assert r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in total)
    again = mixing.take(docs.repartition(5), "doc_id", "source")
    assert got(again, "doc_id", "source", "size", "taken") == multiset((r["doc_id"], r["source"], r["size"], r["taken"]) for r in found)
    assert mixing.mix(docs).columns == docs.columns


def test_block_repeats(docs, rows):
    ws = [brute.WORD.findall(r[1] or "") for r in rows]
    want = []
    for r, w, g in zip(rows, ws, brute.repeats(ws, 35)):
        left = [x for x, y in zip(w, g) if not y]
        want.append((r[0], len(w), len(w) - len(left), brute.sha(" ".join(left).encode())))
    assert got(block_repeats.remove(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == multiset(want)


def test_fingerprints(docs, rows):
    import hashlib

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    want = []
    for a, b in zip(order, order[1:] + order[:1]):
        x, y = a[1] or "", b[1] or ""
        f = len(x) // 3
        want.append((a[0], len(x), hashlib.sha256((x[: len(x) - f] + y[:f]).encode()).hexdigest()))
    found = fingerprints.with_edits(docs)
    assert got(found, "doc_id", "n_chars", "edited_sha256") == multiset(want)
    all_ = found.collect()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in all_)
    by_text = collections.defaultdict(set)
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(docs).collect()}
    for r in rows:
        if r[0] not in (None, 7, 3):
            by_text[r[1] or ""].add(prints[r[0]])
    assert all(len(v) == 1 for v in by_text.values())
    long = max((r for r in all_ if r["n_chars"] > 20000), key=lambda r: r["n_chars"])
    assert 0.4 < long["near_edited"] < 0.95


def plain_anchors(text):
    """{32 bits of the hash: first place} of closed syncmers, k-mer by k-mer."""
    data, out = text.encode(), {}
    one = lambda b: int(fingerprints.byte_hashes(np.frombuffer(b, np.uint8), len(b))[0][0])
    for i in range(len(data) - fingerprints.K + 1):
        kmer = data[i : i + fingerprints.K]
        inner = [one(kmer[j : j + fingerprints.S]) for j in range(fingerprints.K - fingerprints.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.setdefault(one(kmer) >> 32, i)
    if data and not out:
        import hashlib

        out = {int.from_bytes(hashlib.sha256(data).digest()[:4], "big"): 0}
    return out


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    ends = []  # longest run of common anchors in the same order, by all shorter ones
    for h in sorted(a.keys() & b.keys(), key=a.get):
        ends.append((b[h], 1 + max((n for p, n in ends if p < b[h]), default=0)))
    share = max((n for _, n in ends), default=0) / len(a.keys() | b.keys())
    return 2 * share / (1 + share)


def test_fingerprints_equal_plain_syncmers(spark, rows):
    import hashlib

    some = [(r[0], r[1]) for r in rows if len(r[1] or "") < 700]
    order = sorted(some, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    known, want = {}, []
    sketch = lambda t: known.setdefault(t, plain_anchors(t))

    def spelled(a):
        few = sorted(a.items())[: fingerprints.SIZE]
        return " ".join(f"{h:08x} {p:x}" for h, p in sorted(few, key=lambda x: x[1]))

    for a, b in zip(order, order[1:] + order[:1]):
        x, y = a[1] or "", b[1] or ""
        f = len(x) // 3
        e = x[: len(x) - f] + y[:f]
        want.append((a[0], spelled(sketch(x)), spelled(sketch(e)), round(plain_likeness(sketch(x), sketch(e)), 9), round(plain_likeness(sketch(x), sketch(y)), 9)))
    found = fingerprints.with_edits(spark.createDataFrame(some, "doc_id long, text string")).collect()
    assert multiset((r["doc_id"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found) == multiset(want)


def test_ids_of_other_types(spark, docs, rows):
    """Ids as strings: the repeat removers and fingerprints give what they give for numbers, in the order of the strings."""
    import hashlib

    from pyspark.sql import functions as F

    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 5, "0")))
    name = lambda i: None if i is None else f"d{i:05d}"
    for op in (lambda d: suffix_repeats.remove(d, keep_first=False), block_repeats.remove, fingerprints.with_edits):
        value = [c for c in op(docs).columns if c != "doc_id"]
        assert got(op(named), "doc_id", *value) == multiset((name(r["doc_id"]), *(r[c] for c in value)) for r in op(docs).collect())
    # without integers, first copies go by digest
    once = [(name(i), t) for i, t in enumerate(sorted({r[1] or "" for r in rows}))]
    order = sorted(once, key=lambda x: hashlib.md5(x[1].encode()).digest())
    gone = {i: sum(g) for (i, _), g in zip(order, brute.repeats([list(t.encode()) for _, t in order], 200, True))}
    assert {r["doc_id"]: r["n_removed"] for r in suffix_repeats.remove(spark.createDataFrame(once, "doc_id string, text string")).collect()} == gone


def test_many_rows_without_an_id(spark):
    """Rows of null id are dealt by digest: many ranges, and the same ring of neighbours."""
    import hashlib

    texts = [f"text number {i} " * (i % 5) for i in range(300)]
    found = fingerprints.with_edits(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    order = sorted(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    want = [hashlib.sha256((a[: len(a) - len(a) // 3] + b[: len(a) // 3]).encode()).hexdigest() for a, b in zip(order, order[1:] + order[:1])]
    assert multiset(r["edited_sha256"] for r in found) == multiset(want)


def test_likeness():
    a = "the quick brown fox jumps over the lazy dog and runs off into the deep dark woods " * 3
    one, two, none = fingerprints.sketches([a, "x" + a, ""])
    assert fingerprints.likeness(one, one) == 1 and fingerprints.likeness(one, two) > 0.8 and fingerprints.likeness(none, none) == 1 and fingerprints.likeness(one, none) == 0
    back = fingerprints.from_text(fingerprints.to_text(one))
    assert np.array_equal(back[0], one[0]) and np.array_equal(back[1], one[1])


def test_likeness_of_long_texts(spark):
    """Two texts of 20 KB that share 300 bytes: all anchors are compared, the stored fingerprints stay short."""
    r = random.Random(3)
    letters = lambda n: "".join(r.choice("abcdefghij klmnop") for _ in range(n))
    shared = letters(300)
    a, b = (letters(10000) + shared + letters(10000) for _ in range(2))
    found = {x["doc_id"]: x for x in fingerprints.with_edits(spark.createDataFrame([(2, a), (1, b)], "doc_id long, text string")).collect()}
    assert 0.008 < found[2]["near_next"] < 0.022
    assert abs(found[2]["near_edited"] - 2 / 3) < 0.02 and abs(found[1]["near_edited"] - 2 / 3) < 0.02
    assert found[2]["fingerprint"] == fingerprints.to_text(fingerprints.sketches([a])[0]) and len(found[2]["fingerprint"].split()) == 2 * fingerprints.SIZE


def test_empty_tables(nothing):
    frames = [
        tokens.attribute(nothing), suffix_repeats.remove(nothing), licenses.scan(nothing), quality.score(nothing), packing.pack(nothing), minhash.classes(nothing), mixing.take(nothing, "doc_id"),
        block_repeats.remove(nothing), fingerprints.with_edits(nothing), quality.keep(nothing), minhash.keep_one(nothing), suffix_repeats.keep_first(nothing), mixing.mix(nothing),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
