"""Manifest, token-group join and conversation repair against SQL and brute force; lines and names mended."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, decontamination, groups, lines, manifest, mixing, pseudonyms, registry, repair, sharding, simhash
from tidemark.llm.order import placed
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NEW = ["op11_merkle_manifest", "op12_token_group_join", "op13_conversation_repair"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NEW)
def test_new_queries_match_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(registry.SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, rows)[0] == digest(columns, res.fetchall())[0]


def test_places_are_dense_and_in_order(spark):
    rows = [(random.Random(k).choice([None, 1, 2, 2, 3]), k) for k in range(500)]
    got = placed(spark.createDataFrame(rows, "a int, b int").repartition(7), ["a"], "test").orderBy("place").collect()
    assert [r.place for r in got] == list(range(500))
    assert [r.a for r in got] == sorted((r[0] for r in rows), key=lambda a: (a is not None, a))


# manifest ---------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_manifest(rows):
    """(id, leaf) -> (subroot, root, proof) for rows (id, source, leaf)."""
    by_source = {}
    for i, source, leaf in rows:
        by_source.setdefault(source, []).append((i is not None, i, leaf))
    trees = {s: brute_levels([x[2] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2]))]) for s, v in by_source.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    upper = brute_levels([trees[s][-1][0] for s in order])

    def siblings(levels, at):
        out = []
        for level in levels[:-1]:
            first = at // 3 * 3
            out += [x for k, x in enumerate(level[first:first + 3], first) if k != at]
            at //= 3
        return out

    out = []
    for g, source in enumerate(order):
        leaves = sorted(by_source[source], key=lambda x: (x[0], x[1] or 0, x[2]))
        for at, (_, i, leaf) in enumerate(leaves):
            out.append((i, leaf, trees[source][-1][0], upper[-1][0], sha(*siblings(trees[source], at), *siblings(upper, g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [[1], [3, 1], [4, 2, 30, 1, 1, 1, 9, 10, 1, 27, 28]])
def test_manifest_equals_brute_force(spark, sizes):
    rows = [(k * 3 if k else None, None if s == 0 else f"s{s}é" if s % 2 else f"S{s}", sha(str(s), str(k)))
            for s, n in enumerate(sizes) for k in range(n)] + [(3, "twice", sha("x"))] * 4
    leaves = spark.createDataFrame(rows, "id long, source string, leaf string").withColumn("leaf", F.unhex("leaf"))
    proofs, root = manifest.manifest(leaves)
    got = proofs.select("id", manifest.hexed(F.col("digest")), manifest.hexed(F.col("subroot")), F.lit(root),
                        manifest.proof_digest(F.col("proof")), manifest.fold(manifest.hexed(F.col("digest")), F.col("proof")))
    got = [tuple(r) for r in got.collect()]
    assert all(r[5] == root for r in got)
    assert sorted((r[:5] for r in got), key=repr) == brute_manifest(rows)


def test_proofs_are_written_level_by_level(spark):
    """However high the tree, the plan of the proofs joins the leaves with one level."""
    leaves = spark.range(300).select("id", F.lit("a").alias("source"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("leaf"))
    proofs, _ = manifest.manifest(leaves)
    plan = proofs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert proofs.select(F.size("proof").alias("n")).distinct().collect() == [(6,)]


def test_manifest_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "id long, source string, leaf binary")
    proofs, root = manifest.manifest(empty)
    assert proofs.count() == 0 and root is None
    row = spark.createDataFrame([(None, None, "é", 0, "")], "a long, b string, c string, d long, e string")
    assert row.select(manifest.leaf_of(*map(F.col, "abcde"))).first()[0] == sha("--2:é1:00:")


# token groups -----------------------------------------------------------------------------------

def brute_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute_components(sets, percent=85):
    ids = list(sets)
    label = {i: i for i in ids}
    edges = [(a, b) for a, b in itertools.combinations(ids, 2)
             if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


def copies(seed, n_groups, per_group, length, edits):
    rng = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(900)}" for _ in range(length)]
        for _ in range(per_group):
            own = base[:]
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(length)] = f"x{rng.randrange(9000)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("group", [2, 8, 32])
def test_token_groups_equal_brute_force(spark, group):
    common = " ".join(f"c{i}" for i in range(60))
    rows = copies(1, 6, 25, 120, 4) + [(1000 + k, t) for k, t in copies(2, 40, 2, 30, 1)]
    rows += [(2000 + k, f"{common} {' '.join(f'o{k}x{j}' for j in range(k % 12))}") for k in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in groups.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), group=group).collect()}
    sets = {i: brute_sets(t) for i, t in rows}
    assert got == {i: (len(sets[i]), c) for i, c in brute_components(sets).items()}


def test_prefixes_of_similar_sets_share_enough(spark):
    rng = random.Random(5)
    need = {n: r for n, r in spark.range(1, 400).select("id", groups.least(F.col("id"))).collect()}
    for _ in range(400):
        n = rng.randrange(1, 300)
        x = set(range(n))
        y = set(rng.sample(sorted(x), n - rng.randrange(n // 6 + 1))) | {1000 + k for k in range(rng.randrange(n // 6 + 1))}
        if not y or 100 * len(x & y) < 85 * len(x | y):
            continue
        order = rng.sample(sorted(x | y), len(x | y))
        first = lambda s: set([t for t in order if t in s][:groups.prefix_size(len(s))])
        assert len(first(x) & first(y)) >= max(need[len(x)], need[len(y)]) or min(need[len(x)], need[len(y)]) <= len(first(x) & first(y))


def test_first_shingles_are_shared_in_parts(spark):
    """Each shuffle holds a part of the shingles only, and together they find what one would."""
    rows = [(k, 1, [k % 5, k % 7 + 10, 100 + k, -3]) for k in range(40)] + [(40, 40, [500]), (41, 1, [])]
    parts, alive = groups.sharing(spark.createDataFrame(rows, "number long, n long, prefix array<long>"))
    times = {t: sum(t in r[2] for r in rows) for r in rows for t in r[2]}
    got = [[tuple(r) for r in part.select("token", "at", "number").collect()] for part in parts]
    assert len({t % len(parts) for t in times}) == len(parts) > 1
    assert all({r[0] % len(parts) for r in part} == {k} for k, part in enumerate(got))
    assert sorted(sum(got, [])) == sorted((t, at, r[0]) for r in rows for at, t in enumerate(r[2]) if times[t] > 1)
    assert sorted(r[0] for r in alive.collect()) == list(range(40))


def test_token_groups_odd_input(spark):
    long = "lorem ipsum dolor sit amet " * 30_000
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t", None, "b", 3),
            (4, long, "en", "a", 1), (5, "One two", "en", "b", 7), (6, "one TWO", "en", "b", 7), (None, "one two", "en", "b", 7),
            (7, "a b c d e", "en", "c", 9), (7, "a b c d e", "en", "c", 9), (8, long, "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("x")).withColumn("group", F.lit("y")).withColumn("row", F.lit("z"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in groups.near_duplicates(docs).collect()), key=repr)
    want = [(None, 0, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 5, 4), (5, 1, 5), (6, 1, 5), (None, 1, 5), (7, 2, 7), (7, 2, 7), (8, 5, 4)]
    assert got == sorted(want, key=repr)
    assert groups.near_duplicates(docs.limit(0)).count() == 0


# conversation repair ----------------------------------------------------------------------------

def brute_repair(codes):
    """Least (cost, audit) over all edits, by breadth over (row, state) with up to two insertions at each place."""
    best = {"0": (0, "")}

    def inserted(cells):
        for _ in range(3):
            for p, (cost, audit) in list(cells.items()):
                for role in "ua":
                    q = repair.MOVES.get((p, role))
                    if q:
                        cells[q] = min(cells.get(q, (99999, "")), (cost + 2, audit + "I"))
        return cells

    best = inserted(best)
    for code in codes:
        after = {}
        for p, (cost, audit) in best.items():
            options = [(p, cost + 3, "D")]
            if code != "-":
                more = 1 if code.isupper() else 0
                if (p, code.lower()) in repair.MOVES:
                    options.append((repair.MOVES[p, code.lower()], cost + more, "K"))
                options += [(repair.MOVES[p, r], cost + 2 + more, "R") for r in "ua" if (p, r) in repair.MOVES]
            for q, c, letter in options:
                after[q] = min(after.get(q, (99999, "")), (c, audit + letter))
        best = inserted(after)
    return min(best[p] for p in ("0", "A") if p in best)


def test_spans_equal_brute_force():
    for codes in itertools.chain(*(itertools.product("suaxSA-", repeat=n) for n in range(1, 5))):
        cell = repair.parse([repair.ROWS[c] for c in codes])
        assert min(cell[repair.SYMBOLS.index(s)] for s in repair.ACCEPTED) == brute_repair(codes), codes
    rng = random.Random(3)
    for _ in range(100):
        codes = rng.choices("suaxSUAX-", k=rng.randrange(5, 30))
        cell = repair.parse([repair.ROWS[c] for c in codes])
        assert min(cell[repair.SYMBOLS.index(s)] for s in repair.ACCEPTED) == brute_repair(codes), codes


def test_long_and_odd_conversations(spark):
    rng = random.Random(4)
    rows = [("=9", k, rng.choice(["user", "assistant", "system", "tool"]), f"t{rng.randrange(300)}{rng.choice(['.', ''])}") for k in range(700)]
    rows += [("", None, "user", "Hi."), ("", None, "user", "Hi."), ("=1", 5, " ", " "), ("=2", 1, "user", "a?"), ("=2", 9, "assistant", "b!")]
    done, texts = repair.repair(spark.createDataFrame(rows, "key string, turn long, role string, text string"))
    got = {r.key: r for r in done.collect()}
    seen, codes = set(), []
    for _, _, role, text in rows[:700]:
        code = role[0] if role[0] in "sua" else "x"
        codes.append("-" if (role, text) in seen else code if text.endswith(".") else code.upper())
        seen.add((role, text))
    assert (got["=9"].cost, got["=9"].audit) == brute_repair(codes)
    assert got["=9"].duplicate == codes.count("-") and got["=9"].gaps == 0
    pairs = [a[2][0] + b[2][0] for a, b in zip(rows[:700], rows[1:700])]
    assert got["=9"].illegal == sum(p not in ("su", "ua", "au") for p in pairs)
    assert (got[""].audit, got[""].duplicate, got[""].gaps, got[""].illegal) == ("KDI", 1, 0, 1)
    assert (got["=1"].audit, got["=1"].blank, got["=2"].audit, got["=2"].gaps) == ("D", 1, "KK", 7)
    hashes = {r.key: r.sha for r in repair.digests(texts).collect()}
    assert hashes["=2"] == sha("user:a?\nassistant:b!") and hashes["=1"] == sha("") and hashes[""] == sha("user:Hi.\nassistant:")
    roles = "".join(line[0] for r in texts.filter("key = '=9' AND line IS NOT NULL").orderBy("place").collect() for line in r.line.split("\n"))
    assert re.fullmatch("s?(ua)+", roles)


def test_damage_follows_the_checksum(spark):
    rows = [(None if k == 0 else k, None if k % 9 == 0 else k % 5, None if k % 7 == 0 else "assistant", None if k % 11 == 0 else "a.b!") for k in range(200)]
    got = repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = []
    for conv, turn, role, text in rows:
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", " " if text is None else text
        one = ("" if conv is None else f"={conv}", turn, "user" if how == 4 else role, "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text)
        want += [] if how == 0 else [one] * (2 if how == 3 else 1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    empty = spark.createDataFrame([], "key string, turn long, role string, text string")
    assert repair.repair(empty)[0].count() == 0


# mended -----------------------------------------------------------------------------------------

def test_lines_of_shared_and_missing_ids_stay(spark):
    only = "unique words that nobody else ever wrote"
    other = "another unique line standing here alone"
    twice = "the same long line stands in both of them"
    rows = [(None, f"{twice}\n{only}"), (None, f"{twice} now\n{other}"), (5, f"{only} at five\n{twice}"), (5, f"{other} at five two\nmore of it"),
            (1, twice), (5, f"{only} at five\n{twice}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__removed": F.lit(1), "__id": F.lit(2), "row": F.lit(3)})
    got = lines.deduplicate(docs)
    texts = [r.text for r in got.collect()]
    assert len(texts) == 6 and got.columns == [*docs.columns, "n_removed"]
    kept = [line for t in texts for line in t.split("\n")]
    assert kept.count(twice) == 1 and f"{twice} now" not in kept
    for line in (only, other, f"{other} at five two", "more of it"):
        assert line in kept


def test_internal_names_do_not_clash(spark):
    rows = [(1, "call 415-555-0132 or mail jane@example.com " * 12), (2, "q1 q2 q3 q4 q5 q6 q7 q8 q9 " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {n: F.lit("own") for n in ("__found", "__new", "__row_key", "__ranges", "source")})
    items = spark.createDataFrame([(1, "q1 q2 q3 q4 q5 q6")], "item_id long, text string")
    assert pseudonyms.pseudonymise(docs).drop("n_pseudonyms").columns == docs.columns
    for out in (simhash.keep_first(docs), decontamination.decontaminate(docs, items), mixing.mixed_documents(docs),
                sharding.sharded_documents(docs).drop("shard", "slot")):
        assert out.columns == docs.columns and {r["__row_key"] for r in out.collect()} == {"own"}


def test_sets_are_grouped_in_parts_that_go_one_by_one(spark):
    """Equal sets meet in one part, every class has its own number, and no part's first shingles outlast its classes."""
    rows = [(k, k, 4, k % 7, k % 7 + 1, 0, 0, [k % 7, 50]) for k in range(30)] + [(30, 30, 0, 99, 99, 0, 0, [])]
    sketched = spark.createDataFrame(rows, "doc_id long, row long, n long, c1 long, c2 long, s1 long, s2 long, prefix array<long>")
    parts = common.materialize_parts(sketched, "test", F.pmod("c1", F.lit(9)), 9)  # two parts stay empty
    folders = [common.WRITTEN[p] for p in parts]
    assert sorted(r.doc_id for p in parts for r in p.collect()) == list(range(31))
    classes, sizes = groups.distinct_sets(parts)
    got = [r for c in classes for r in c.collect()]
    assert sorted((r.c1, r.first_id, tuple(r.prefix)) for r in got) == [(k, k, (k, 50)) for k in range(7)]
    assert len({r.number for r in got}) == 7 and sizes.count() == 31
    assert not any(os.path.exists(f) for f in folders)


def test_lines_are_placed_by_longs(spark):
    """Classes are numbered by the places of their first lines, so no shuffle by range numbers them."""
    docs = lines.numbered(spark.createDataFrame([(3, "a b c\nd e f"), (2 ** 32 - 1, "d e f\n\ng")], "doc_id long, text string"))
    _, own = lines.classes(docs, lines.rarity(docs))
    assert dict(own.dtypes)["number"] == "bigint"
    assert sorted(r.number for r in own.collect()) == [3 << 31, 3 << 31 | 1, (2 ** 32 - 1) << 31 | 2]


@pytest.mark.parametrize("ids", [[-2 ** 63, -1, 2 ** 63 - 1, None], [0, 1, 2 ** 32 - 1, 2 ** 32], [0, 7, 2 ** 31, 2 ** 32 - 1]])
def test_lines_of_wide_ids_keep_their_order(spark, ids):
    rows = [(i, f"the same line stands in all of them\nown line number {k} x{k} y{k} z{k}") for k, i in enumerate(ids)]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduplicate(spark.createDataFrame(rows[::-1], "doc_id long, text string")).collect()}
    assert got == {i: (t if k == 0 else t.split("\n")[1], int(k > 0)) for k, (i, t) in enumerate(rows)}


def test_lines_with_frequent_words_meet_their_leader(spark):
    """A group of near copies whose words are frequent is settled by its first line; rare words lead to no leader."""
    base = [f"w{k}" for k in range(20)]
    rows = [(k, " ".join([*base, f"own{k}"])) for k in range(lines.FREQUENT + 20)] + [(1000, "rare one two three"), (1001, "rare one two three four")]
    docs = lines.numbered(spark.createDataFrame(rows, "doc_id long, text string"))
    _, own = lines.classes(docs, lines.rarity(docs))
    pairs = lines.leader_pairs(own).collect()
    assert {(r.a >> lines.LINE_BITS, r.b >> lines.LINE_BITS) for r in pairs} == {(0, k) for k in range(1, lines.FREQUENT + 20)}
    got = {r.doc_id: r.n_removed for r in lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(0 < i < 1000 or i == 1001) for i, _ in rows}


def test_line_pairs_that_differ_in_many_parities_go_before_their_sets(spark):
    """Long lines that 64 parities cannot tell apart: 128 drop the unlike pairs, and no similar one."""
    rng = random.Random(4)
    sets = [[rng.getrandbits(62) for _ in range(150)] for _ in range(20)]
    sets += [[*s[:140], *(rng.getrandbits(62) for _ in range(10))] for s in sets]
    docs = spark.createDataFrame(list(enumerate(sets)), "number long, words array<long>")
    known = docs.select("number", F.size("words").alias("n"), *lines.parities(F.col("words")), lines.parity(F.col("words")).alias("parity"))
    assert known.filter(F.col("low").bitwiseXOR(F.col("high")) != F.col("parity")).isEmpty()
    pairs = spark.createDataFrame(list(itertools.combinations(range(40), 2)), "a long, b long")
    got = {(r.a, r.b) for r in lines.nearer(pairs, known, lines.THRESHOLD).collect()}
    assert {(k, k + 20) for k in range(20)} <= got and len(got) < 60


def test_lines_leave_no_tables_and_whole_texts_are_not_joined(spark):
    """Tables of classes and lines are deleted; only documents that may lose a line meet their removed lines."""
    before = set(os.listdir(common.shared_dir(spark).removeprefix("file:"))) if os.path.isdir(common.shared_dir(spark).removeprefix("file:")) else set()
    rows = [(k, f"line that stands in each of them\nown{k} words{k} alone{k}" if k < 5 else f"lonely{k} text{k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in lines.deduplicate(docs).collect()}
    assert got == {k: int(0 < k < 5) for k in range(40)}
    left = set(os.listdir(common.shared_dir(spark).removeprefix("file:"))) - before
    assert not [x for x in left if x.startswith(("llm-line-classes", "llm-line-ids", "llm-line-numbers", "llm-line-sets"))]
    may = lines.may_be_in(docs, F.col("doc_id"), spark.createDataFrame([(k,) for k in range(1, 5)], "doc_id long"), lines.DOCUMENT_BITS)
    assert {r.doc_id for r in may.filter("may").collect()} == {1, 2, 3, 4} and may.count() == 40


def test_line_sets_are_made_without_rows_that_hold_the_rarity_table(spark):
    """Sets of lines at given places, each once although a row repeats; no aggregate's rows hold the table of a byte a bucket."""
    rows = [(1, "b a a\n\nc\td"), (1, "b a a\n\nc\td"), (2, "e  F g\x0b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    steps, places = lines.rarity(docs), spark.createDataFrame([(1 << 31,), (1 << 31 | 2,), (2 << 31,), (3 << 31,)], "number long")
    sets = lines.sets_at(docs, places, steps)
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and not [x for x in plan.split("\n") if "Aggregate [" in x and "scalar-subquery" in x]
    assert sorted((r.number, r.n, len(r.words)) for r in sets.collect()) == [(1 << 31, 2, 2), (1 << 31 | 2, 2, 2), (2 << 31, 3, 3)]


def test_line_candidates_are_those_of_all_pairs(spark):
    """A smaller set meets larger ones on half of its prefix, and no pair that the filters pass is lost; hashes are deleted."""
    rng = random.Random(7)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(3, 40))] for _ in range(12)]
    texts = [" ".join([w for w in rng.choice(base) if rng.random() > 0.06] + [f"x{rng.randrange(60)}" for _ in range(rng.randrange(3))]) for _ in range(150)]
    docs = lines.numbered(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "text")
    hashed = common.materialize(lines.hashed_lines(docs), "line-hashes")
    folder = common.WRITTEN[hashed]
    steps = lines.rarity(docs, hashed=hashed)
    _, own = lines.classes(docs, steps, hashed=hashed)
    assert not os.path.exists(folder.removeprefix("file:"))
    marked = own.withColumn("open", F.col("number") % (5 << 31) != 0)
    got = [(r.a >> 31, r.b >> 31) for part in lines.candidates(marked) for r in part.collect()]
    sets = [frozenset(t.split()) for t in texts]
    first = {}
    for k, s in enumerate(sets):
        first.setdefault(s, k)
    similar = {(a, b) for a, b in itertools.combinations(sorted(first.values()), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12}
    assert {(a, b) for a, b in similar if b % 5} <= set(got) and len(similar) > 50
    assert all(a < b and b % 5 for a, b in got)


def test_groups_are_opened_in_parts_and_members_get_labels_afterwards(spark):
    """Links between labels are those of brute force, from groups of every part, and the queries' table is deleted."""
    base = [[100 * g + t for t in range(40)] for g in range(5)]
    sets = [(8 * g + k, g, [*base[g][k:], 900 + k]) for g in range(5) for k in range(4)] + [(100 + g, 9, [*base[g], 950]) for g in range(5)]
    labels = {i: i - i % 8 if i % 8 < 2 and i < 100 else i for i, _, _ in sets}
    pairs = [(100 + g, g) for g in range(5)] + [(0, 9), (0, 1)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in (
        (pairs, "id long, group long"), (sets, "id long, group long, tokens array<long>"), (list(labels.items()), "id long, label long"))]
    folder = common.shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in groups.opened_for(*frames).collect()}
    tokens = {i: set(t) for i, _, t in sets}
    want = {tuple(sorted((labels[q], labels[i]))) for q, g in pairs for i, own, _ in sets if own == g and labels[q] != labels[i]
            and 100 * len(tokens[q] & tokens[i]) >= 85 * len(tokens[q] | tokens[i])}
    assert got == want and len(want) > 5
    assert not [x for x in set(os.listdir(folder)) - before if x.startswith("llm-group-queries")]
