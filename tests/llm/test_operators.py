"""Each operator against brute force, and its defined results for odd input."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, decontamination, lines, mixing, pseudonyms, quality, registry, sharding, simhash, toxicity, urls,
)
from tidemark.llm.graph import components

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 40_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    text = " ".join(f"word{i % 97} thing{i % 89}" for i in range(200))
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t ", None, "b", 5),
            (4, LONG, "en", "a", len(LONG)), (5, text, "en", "b", len(text)), (5, text, "en", "b", len(text)),
            (6, text, "de", None, len(text)), (None, text, "en", "c", None), (7, "é ü \u4f60\u597d", "xx", "c", 6)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Extra columns with names that the operators use inside."""
    for name in ("size", "fp", "words", "label", "shard", "n_words", "row_key", "n_removed", "number", "component_id", "n_pseudonyms"):
        df = df.withColumn(name, F.lit("extra"))
    return df


# quality ----------------------------------------------------------------------------------------

def brute_counts(text):
    ws = words_of(text)
    windows = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    inside = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    own = [x for x in (text or "").split("\n") if words_of(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(own) - len(set(own)), len(inside)


def test_quality_counts_and_verdicts(spark, docs):
    got = {r.doc_id: r for r in quality.query(spark, SF).collect()}
    for r in docs.collect():
        assert tuple(got[r.doc_id][1:6]) == brute_counts(r.text)
        fails = got[r.doc_id].n_words < 50 or 100 * got[r.doc_id].n_repeat_words > 50 * got[r.doc_id].n_words
        assert got[r.doc_id].base_failed == fails and not (fails and got[r.doc_id].kept)
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {k for k, r in got.items() if r.kept}


def test_quality_agrees_with_labels(spark):
    judged = quality.query(spark, "/root/testdata/sf0.01").drop("quality").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("NOT base_failed")
    good, bad = judged.filter("quality = 1"), judged.filter("quality = 0")
    assert good.filter("kept").count() >= 0.98 * good.count()
    assert bad.filter("kept").count() <= 0.1 * bad.count()


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    hit = [0.9, 0.8, 0.7, 0.85]
    digits = np.stack([np.where(rng.random(len(truth)) < h, np.where(truth, 0, 2), np.where(truth, 2, 0)) for h in hit], 1)
    patterns, counts = np.unique(digits @ 3 ** np.arange(3, -1, -1), return_counts=True)
    model = quality.fit(patterns, counts, 4)
    assert np.allclose(model.chance[1, :, 0], hit, atol=0.03) and abs(model.good_share - 0.8) < 0.03
    assert quality.fit(np.zeros(0, int), np.zeros(0), 4).good_share == 0.85


def test_quality_odd_input(odd, empty):
    assert quality.quality(odd).count() == odd.count()
    assert quality.quality(empty).count() == 0 and quality.keep_good(empty).count() == 0
    kept = quality.keep_good(clashing(odd))
    assert kept.columns == clashing(odd).columns


# simhash ----------------------------------------------------------------------------------------

def test_covering_masks_miss_no_pair():
    rng = np.random.default_rng(2)
    for family in (0, 1):
        masks = simhash.covering_masks(4, family)
        assert len(masks) == 31
        for _ in range(500):
            differ = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(differ & m == 0 for m in masks)


def brute_components(ids, fps, radius=4):
    comp = list(range(len(ids)))
    for _ in ids:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and comp[j] < comp[i]:
                    comp[i], changed = comp[j], True
        if not changed:
            break
    return {ids[i]: min(ids[j] for j in range(len(ids)) if comp[j] == comp[i]) for i in range(len(ids))}


def brute_fingerprint(text):
    ws = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    if not ws:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + 4]), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, docs):
    rows = simhash.query(spark, SF).collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == fps
    assert {r.doc_id: r.component_id for r in rows} == brute_components(list(fps), list(fps.values()))


def test_large_buckets_are_hashed_again(spark):
    rng = np.random.default_rng(3)
    fps = sorted({0b1011 ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(400)})
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    label = components(simhash.links(frame, 4, bucket=16))
    assert label.count() == len(fps) and label.select("label").distinct().count() == 1


def test_simhash_odd_input(odd, empty):
    assert simhash.near_duplicates(odd).count() == odd.count()
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(clashing(odd))
    assert kept.columns == clashing(odd).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 7]  # null, blank: one; equal texts: one


# decontamination --------------------------------------------------------------------------------

def test_overlaps_find_substituted_passages(spark):
    item = [f"q{i}" for i in range(30)]
    cut = item[:]
    cut[4] = cut[11] = cut[20] = "other"
    filler = [f"f{i}" for i in range(300)]
    rows = [(1, " ".join(filler + item + filler)), (2, " ".join(filler + cut)), (3, " ".join(filler)),
            (4, " ".join(item[:9] + filler)), (5, " ".join(filler + item[5:20])), (6, "Q1? q2, a-b c d")]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "a b c d e"), (9, "q1 q2"), (None, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.overlaps(
        spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert set(got) == {(1, 7), (2, 7), (5, 7)}
    assert (got[1, 7].start, got[1, 7].n_aligned) == (300, 30) and got[2, 7].n_equal == 27
    short = spark.createDataFrame([(10, "x a b c d e y")], "doc_id long, text string")
    assert [r.item_id for r in decontamination.overlaps(short, bench).collect()] == [8]


def test_overlaps_equal_exact_search(spark, docs):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    plain = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    want = {(r.doc_id, k) for r in docs.collect() for k, t in bench.items() if plain(t) in plain(r.text)}
    assert {(r.doc_id, r.item_id) for r in decontamination.query(spark, SF).collect()} >= want


def test_masks_hit_every_admissible_pattern():
    # longer stretches hold one of 13 to 25 tokens that is as much alike
    for n in range(decontamination.SHORT, 26):
        seeds = [decontamination.mask_list(decontamination.MASKS)[m] for m in decontamination.masks_for(n, decontamination.MASKS)]
        reads = [sum(1 << at + k for k, c in enumerate(m) if c == "1") for m in seeds for at in range(n - len(m) + 1)]
        for other in itertools.combinations(range(n), n - math.ceil(0.8 * n - 1e-9)):
            changed = sum(1 << k for k in other)
            assert any(not r & changed for r in reads), (n, other)


def test_overlaps_find_items_of_every_short_length(spark):
    items, rows = [], []
    for n in range(5, 14):
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for other in itertools.combinations(range(n), n - math.ceil(0.8 * n)):
            rows.append((n, " ".join(["before", *("other" if k in other else w for k, w in enumerate(item)), "after"])))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(
        docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, n) for i, (n, _) in enumerate(rows)}


def test_longest_alike_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        equal = rng.random(rng.integers(0, 25)) < 0.7
        best = max((j - i for i in range(len(equal) + 1) for j in range(i, len(equal) + 1)
                    if equal[i:j].sum() >= 0.8 * (j - i) - 1e-9), default=0)
        i, j = decontamination.longest_alike(equal, 0.8)
        assert j - i == best


def test_decontamination_odd_input(spark, odd, empty):
    bench = spark.createDataFrame([(1, " ".join(f"word{i % 97} thing{i % 89}" for i in range(20)))], "item_id long, text string")
    kept = decontamination.decontaminate(clashing(odd), bench)
    assert kept.columns == clashing(odd).columns and kept.count() == 6
    assert decontamination.decontaminate(empty, bench).count() == 0
    assert decontamination.decontaminate(odd, bench.limit(0)).count() == odd.count()


# toxicity ---------------------------------------------------------------------------------------

def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) > 0.6 * len(toxic) and sum(r.predicted for r in clean) < 0.02 * len(clean)


def test_toxicity_uses_no_held_out_label(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (dict(toxicity.toxicity(docs, x).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert a == b


def test_toxicity_odd_input(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, None), (5, 0, 0), (6, 1, 1), (6, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(clashing(odd), labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.5}


# lines ------------------------------------------------------------------------------------------

def brute_lines(rows):
    seen, out = [], {}
    for doc_id, text in sorted(rows):
        keep = []
        for line in text.split("\n"):
            s = frozenset(words_of(line.lower()))
            if not s or not any(len(s & o) >= 0.8 * len(s | o) - 1e-12 for o in seen):
                keep.append(line)
            if s:
                seen.append(s)
        out[doc_id] = "\n".join(keep)
    return out


def test_line_dedup_equals_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.filter("doc_id < 60").collect()]
    got = {r.doc_id: r.text for r in lines.deduplicate(docs.filter("doc_id < 60")).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_near_copies_around_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows = []
    for doc in range(120):  # six base lines of 5 to 30 words, of which up to a third are changed, dropped or added
        base = [f"w{(doc % 6) * 40 + k}" for k in range(5 * (doc % 6 + 1))]
        copies = []
        for _ in range(3):
            line = [f"x{rng.integers(50)}" if rng.random() < rng.choice([0, 0.05, 0.1, 0.3]) else w for w in base]
            cut = rng.integers(0, len(line) // 4 + 1)
            copies.append(" ".join(line[cut:] + [f"y{rng.integers(30)}" for _ in range(rng.integers(0, 3))]))
        rows.append((doc, "\n".join(copies)))
    got = {r.doc_id: r.text for r in lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = brute_lines(rows)
    assert got == expected and 0 < sum(t != expected[i] for i, t in rows)


def test_line_dedup_odd_input(spark, odd, empty):
    got = lines.deduplicate(clashing(odd))
    assert got.columns == [c for c in clashing(odd).columns if c != "n_removed"] + ["n_removed"] and got.count() == odd.count()
    by = {(r.doc_id, r.text is None): r for r in got.collect()}
    assert by[2, False].text == "" and by[3, False].text == " \n\t " and by[1, True].text is None
    assert by[5, False].n_removed == 0 and by[6, False].text == "" and by[None, False].n_removed == 1
    assert lines.deduplicate(empty).count() == 0
    near = spark.createDataFrame([(1, "a b c d e\nx\na b c d"), (2, "A\tb c d\ne f")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.deduplicate(near).collect()} == {1: "a b c d e\nx", 2: "e f"}


# chat -------------------------------------------------------------------------------------------

def test_chat_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert sorted(map(tuple, registry.QUERIES["op5_chat_formatting"](spark, SF).collect())) == sorted(con.execute(chat.SQL).fetchall())


def test_chat_round_trip(spark):
    evil = ["<turn>user<text>", "\\l\\b<", "</turn>\n", "", "\\", "é" * 5, "<part>", LONG]
    rows = [(1, i, ("user", "assistant", "assistant", None, "<text>")[i % 5], t) for i, t in enumerate(evil)]
    rows += [(2, 0, "user", None), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, None, None, None)]
    turns = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = chat.format_conversations(turns).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    got = {r.conv_id: r for r in out}
    want = [(r[2] or "", r[3] or "") for r in rows[:len(evil)]]
    assert [tuple(t) for t in got[1].turns] == want
    assert got[1].loss == "".join(t for role, t in want if role == "assistant")
    assert got[1].formatted.count("<turn>") == 1 + sum(a[0] != b[0] for a, b in zip(want, want[1:]))
    assert [tuple(t) for t in got[2].turns] == [("assistant", "tie"), ("assistant", "tie"), ("user", "")]
    assert [tuple(t) for t in got[None].turns] == [("", "")]
    assert chat.format_conversations(turns.limit(0)).count() == 0


# urls -------------------------------------------------------------------------------------------

def brute_url(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r, _ in urls.RULES if (f".{host}").endswith("." + r.partition("/")[0]) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules(spark):
    given = [None, "", "x", "http://", "http://A.Example.ORG/en/12?q#f", "http://org", "http://org/", "http://xorg/", "ftp://x.com/de/é/",
             "http://x.com?u=/de/", "http://x.com#/de/", "http://x.com/fr/1", "http://example.org/es/", "a://b://c/d", "http://É.com/de/1"]
    pages = clashing(spark.createDataFrame(list(enumerate(given)), "page_id long, url string"))
    got = {r.page_id: r for r in urls.filter_urls(pages).collect()}
    verdicts = dict(urls.RULES)
    for i, url in enumerate(given):
        assert (got[i].host, got[i].path, got[i].rule) == brute_url(url)
        assert got[i].verdict == verdicts.get(got[i].rule, got[i].verdict) and got[i].verdict in ("allow", "block")
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_url_templates_split_where_labels_differ(spark):
    rows = [f"http://s.com/{b}/{i}.html" for b in ("de", "fr", "en") for i in range(60)] + ["http://u.net/p/1"]
    got = urls.filter_urls(spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")).collect()
    by = defaultdict(set)
    for r in got:
        by[r.path.split("/")[1]].add(r.template.split("/")[1])
    assert by == {"de": {"de"}, "fr": {"fr"}, "en": {"*"}, "p": {"*"}}
    bad = spark.createDataFrame([(i, f"http://t.com/de/{i}") for i in range(90)] + [(99, "http://t.com/x/1")], "page_id long, url string")
    assert {r.verdict for r in urls.filter_urls(bad).collect()} == {"block"}  # x shares the host's purity


def judged(spark, rows):
    """The judgement of (host, path, verdict of the rule or None) pages whose rules are their own paths."""
    rules = tuple((h + p, v) for h, p, v in rows if v)
    pages = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p, _) in enumerate(rows)], "page_id long, url string")
    return sorted(urls.filter_urls(pages, rules).collect(), key=lambda r: r.page_id)


def test_url_templates_reach_the_last_segment(spark):
    rows = [("t.net", f"/a/b/c/d/{last}/{i}", verdict) for last, verdict in (("bad", "block"), ("good", "allow")) for i in range(8)]
    rows += [("t.net", f"/a/b/c/d/{last}/99", None) for last in ("bad", "good")]
    rows += [("t.net", "/z" * 300, None), ("u.net", "/a/b/c/d/e/f/g/h", None)]
    got = judged(spark, rows)
    assert [r.verdict for r in got[16:18]] == ["block", "allow"]
    assert got[16].template != got[17].template and got[18].template.count("/") == 300 and got[19].template == "/*" * 8


def test_similar_siblings_are_merged(spark):
    rows = [("t.net", f"/{s}/{i}", "block" if i else "allow") for s in "ab" for i in range(9)]
    rows += [("t.net", f"/{s}/{i}", "allow") for s in "cd" for i in range(9)]
    got = judged(spark, rows)
    by = defaultdict(set)
    for r in got:
        by[r.path[1]].add(r.template.split("/")[1])
    assert by == {"a": {"{a|b}"}, "b": {"{a|b}"}, "c": {"{c|d}"}, "d": {"{c|d}"}}


def test_no_two_merged_branches_are_similar():
    rng = np.random.default_rng(6)
    for _ in range(50):
        branches = [(f"s{k}", int(rng.integers(0, 40)), int(rng.integers(0, 40))) for k in range(int(rng.integers(1, 12)))]
        names = urls.merged(branches)
        sums = defaultdict(lambda: np.zeros(2))
        for name, (_, blocked, allowed) in zip(names, branches):
            if blocked + allowed:
                sums[name] += (blocked, blocked + allowed)
        groups = [([], b, n) for b, n in sums.values()]
        assert all(urls.unlike(x, y) > urls.SIMILAR for x, y in itertools.combinations(groups, 2))


# mixing -----------------------------------------------------------------------------------------

def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = full - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        target = {s: 2 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in open_) for s in order}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def check_mix(rows, text_of):
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(words_of(text_of[r.doc_id][1])) and 0 <= r.taken <= 2 * r.size
        sizes[text_of[r.doc_id][0]] += r.size
        taken[text_of[r.doc_id][0]] += r.taken
    target = brute_targets(sizes)
    for r in rows:
        source = text_of[r.doc_id][0]
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_mixing_meets_its_targets(spark, docs):
    got = mixing.query(spark, SF)
    rows = got.collect()
    check_mix(rows, {r.doc_id: (r.source, r.text) for r in docs.collect()})
    assert sorted(rows) == sorted(mixing.query(spark, SF).collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got_words = Counter()
    for r in mixed.collect():
        got_words[r.doc_id] += len(words_of(r.text))
        assert r.n_chars == len(r.text)
    assert got_words == Counter({r.doc_id: r.taken for r in rows if r.taken})


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000):
        out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 12345))
        assert sorted(out) == list(range(n))


def test_mixing_odd_input(odd, empty):
    rows = mixing.mix(clashing(odd)).collect()
    assert len(rows) == odd.count() and sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r.size for r in rows), abs=4)
    mixed = mixing.mixed_documents(clashing(odd))
    assert mixed.columns == clashing(odd).columns
    assert sum(len(words_of(r.text)) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    blank = odd.filter("doc_id IN (1, 2, 3)")
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0, 0] and mixing.mixed_documents(blank).count() == 0


# sharding ---------------------------------------------------------------------------------------

def check_shards(rows, n_rows, n_shards=40):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert len(rows) == n_rows and all(sorted(x) == list(range(len(x))) for x in by.values())
    counts = [len(by[s]) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(n_shards))


def test_sharding_keeps_groups_and_counts(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.query(spark, "/root/testdata/sf0.01").collect()
    check_shards(rows, source.count())
    text = {r.doc_id: r.text for r in source.collect()}
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 16, zlib.crc32(text[r.doc_id].encode())) for r in rows)
    where = defaultdict(set)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())


def test_hot_group_fills_shards(spark):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}") for i in range(900)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check_shards(got, 900, 10)
    assert len({r.shard for r in got if r.doc_id % 3 == 0}) <= 5  # 300 documents, 90 to a shard


def test_groups_stay_whole_where_every_document_has_a_copy(spark):
    rows = [(i, f"text {i // 2}") for i in range(4000)] + [(4000 + i, f"more {i // 5}") for i in range(1000)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    check_shards(got, 5000, 10)
    where = defaultdict(set)
    for r in got:
        where[rows[r.doc_id][1]].add(r.shard)
    assert sum(len(x) > 1 for x in where.values()) < 10  # at most one at each border of two shards


def test_sharding_odd_input(odd, empty):
    check_shards(sharding.shards(odd).collect(), odd.count())
    out = sharding.sharded_documents(clashing(odd))
    assert out.count() == odd.count() and out.columns == [c for c in clashing(odd).columns if c != "shard"] + ["shard", "slot"]
    assert sharding.sharded_documents(empty).count() == 0


# pseudonyms -------------------------------------------------------------------------------------

def luhn(text):
    d = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])


def test_pseudonyms_keep_formats_and_links(spark):
    values = ["4111111111111111", "9807915762804490", "a.b7@mail7.example.com", "+1 (017) 555-7713", "974-555-3436", "233.254.104.120",
              "123-45-6789", "1999-12-31", "2024/02/29", "29.02.2024", "GB82WEST12345698765432", "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"]
    stay = ["666-45-6789", "2023-02-30", "4.0.", "3.14", "1.2.3.4.5", "GB00WEST12345698765432", "12345"]
    rows = [(i, f'x "{v}"!! é\n({v})') for i, v in enumerate(values)] + [(100 + i, f"x {v} y") for i, v in enumerate(stay)]
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shape = lambda t: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", t)))
    for i, value in enumerate(values):
        first, second = re.fullmatch(r'x "(.*)"!! é\n\((.*)\)', got[i].text).groups()
        assert first == second != value and got[i].n_pseudonyms == 2
        if "." not in value or "@" in value or value == "29.02.2024":
            assert shape(first) == shape(value)
    assert all(got[100 + i].text == rows[len(values) + i][1] for i in range(len(stay)))
    assert luhn(re.search(r"\d+", got[0].text)[0]) % 10 == 0 != luhn(re.search(r"\d+", got[1].text)[0]) % 10
    assert re.search(r"\d{4}/\d\d/\d\d", got[8].text)[0].split("/") == re.search(r"\d\d\.\d\d\.\d{4}", got[9].text)[0].split(".")[::-1]


def test_values_alone_in_a_text_are_found(spark):
    values = ["jane_@example.com", "jane.@example.com", "j%@example.com", "j+@example.com", "j-@example.com", "a@b.de", "1.2.3.4",
              "GB82WEST12345698765432", "1999-12-31", "123-45-6789", "+1 (917) 555-7713", "4111111111111111", "b4" * 16]
    rows = [(i, v) for i, v in enumerate(values)] + [(100 + i, f"{v} in 2024") for i, v in enumerate(values)]
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, value in enumerate(values):
        assert got[i].text != value and got[i].n_pseudonyms == 1 and got[100 + i].text == f"{got[i].text} in 2024"


def test_long_hex_keys_are_replaced(spark):
    keys = ["b4" * (n // 2) for n in (200, 202, 256, 4096)] + ["C" * 300 + "7" * 100]
    rows = [(i, f"key {k}.") for i, k in enumerate(keys)] + [(9, "f" * 300), (10, "7" * 300)]
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, key in enumerate(keys):
        new = re.fullmatch(r"key ([0-9a-fA-F]+)\.", got[i])[1]
        assert new != key and len(new) == len(key) and [c.isdigit() for c in new] == [c.isdigit() for c in key]
    assert got[9] == "f" * 300 and got[10] == "7" * 300


def test_feistel_is_a_permutation(spark):
    vector = F.array(pseudonyms.digit((F.col("id") / 30).cast("int"), 20), pseudonyms.digit(F.col("id") % 30, 30))
    out = spark.range(600).select(pseudonyms.permute(vector, F.lit("test")).alias("v")).collect()
    assert {tuple(r.v) for r in out} == {(a, b) for a in range(20) for b in range(30)}


def test_pseudonyms_odd_input(spark, odd, empty):
    out = pseudonyms.pseudonymise(clashing(odd))
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert out.columns == [c for c in clashing(odd).columns if c != "n_pseudonyms"] + ["n_pseudonyms"]
    assert pseudonyms.pseudonymise(empty).count() == 0
    long = spark.createDataFrame([(1, LONG + "4111111111111111")], "doc_id long, text string")
    assert pseudonyms.pseudonymise(long).first().text.startswith(LONG)


def test_digests_are_of_the_probe(spark):
    got = {r.conv_id: r for r in chat.query(spark, SF).collect()}[-7]
    assert got.loss_sha256 == hashlib.sha256(chat.PROBE.encode()).hexdigest() and got.n_turns == 2
