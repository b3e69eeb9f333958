"""The n-gram join, the classifiers, fingerprints, packing and mixing against brute force, and on odd tables."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from guidemill.llm import common, fingerprint, mixing, ngram_join, ordinal, packing, quality, toxicity
from guidemill.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, size long, copies long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(texts, ids=None, sources=None):
    ids = ids or list(range(len(texts)))
    sources = sources or [f"s{k % 3}" for k in range(len(texts))]
    return [(i, t, None, s, None, 1, 2, 3) for i, t, s in zip(ids, texts, sources, strict=True)]


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(3)
    words = ["".join(chance.choice("abcdefgh") for _ in range(chance.randint(2, 6))) for _ in range(300)]
    base = [" ".join(chance.choice(words) for _ in range(60)) for _ in range(6)]
    out = ["", None, " \t\n", "One", "one", "ONE two", "É è", "x" * 3000, " ".join(words * 20), *base, *base[:2], base[0].upper()]
    for b in base[:4]:  # near copies, chains of them, and copies that are too far away
        w = b.split()
        for k in (1, 2, 3, 5, 9):
            v = list(w)
            for _ in range(k):
                v[chance.randrange(len(v))] = chance.choice(words)
            out.append(" ".join(v))
    return out


def brute_components(docs, width, percent):
    sets = []
    for _, text in docs:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(docs)))
    for _ in docs:
        for a in range(len(docs)):
            for b in range(len(docs)):
                x, y = sets[a], sets[b]
                if x and y and docs[a][0] is not None and docs[b][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    least = defaultdict(list)
    for k, (i, _) in enumerate(docs):
        least[label[k]].append(i)
    return sorted(((i, len(sets[k]), min(least[label[k]]) if i is not None else None) for k, (i, _) in enumerate(docs)), key=str)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_ngram_join_is_brute_force(spark, texts, width, percent):
    ids = list(range(len(texts)))
    ids[3], ids[12], ids[-1] = None, ids[11], 999  # without an id, an id twice
    docs = spark.createDataFrame(rows(texts, ids), SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in ngram_join.ngram_jaccard_join(docs, width, percent).collect()), key=str)
    assert got == brute_components(list(zip(ids, texts, strict=True)), width, percent)


def test_ngram_join_same_prefix_group_and_no_rows(spark):
    assert ngram_join.ngram_jaccard_join(spark.createDataFrame([], SCHEMA)).collect() == []
    long = [f"w{k}" for k in range(200)]
    docs = [" ".join([*long, *(f"t{j}x{k}" for k in range(3))]) for j in range(6)]  # differ in their ends only
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows(docs), SCHEMA), 5, 80).collect()
    assert {r.component_id for r in got} == {0}


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_pairs_of_a_list_are_those_that_sizes_and_places_allow(spark, percent):
    chance = random.Random(percent)
    entries = []
    for k in range(300):
        n = chance.choice([1, 2, 3, chance.randint(4, 40), chance.randint(80, 120)])
        entries.append((chance.randint(0, 2), k, n, chance.randrange(ngram_join.prefix_length(n, percent)), chance.randint(0, 40)))
    wide = spark.createDataFrame(entries, "tok long, node long, n long, pos long, component long")
    got = {tuple(r) for r in ngram_join._apart_pairs(wide, percent).collect()}
    want = set()
    for t, u, n, i, c in entries:
        for s, v, m, j, d in entries:
            if t == s and u < v and c != d and min(n, m) * 100 >= max(n, m) * percent and min(n - i, m - j) * (100 + percent) >= percent * (n + m):
                want.add((u, v))
    assert got == want


def test_many_versions_of_a_template_that_do_not_link(spark):
    chance = random.Random(12)
    template = [f"w{k}" for k in range(100)]
    docs = []
    for j in range(3000):
        w = list(template)
        for k in (chance.randrange(a, a + 25) for a in (5, 35, 65)):  # so that each change spoils five shingles of its own
            w[k] = f"x{j}y{k}"
        docs.append(" ".join(w))
    docs += [docs[0].replace("w99", "z"), docs[7].replace("w0", "z")]
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_join(spark.createDataFrame(rows(docs), SCHEMA).repartition(4), 5, 80).collect()}
    assert got == {k: {3000: 0, 3001: 7}.get(k, k) for k in range(3002)}


def test_shingles_fold_ascii_only_and_prefix_is_long_enough():
    import pyarrow as pa

    a, b, c, d = common.shingle_sets(pa.array(["A b C d", "a B c D", "É b c d", "é b c d"]), 4)
    assert (a == b).all() and not (c == d).all()
    for n in range(1, 200):
        for percent in (80, 85, 100):
            need = -(-percent * n // 100)
            assert ngram_join.prefix_length(n, percent) == n - need + 1


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(common.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)}
    assert common.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_classifiers_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fit, rest = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    got = quality.quality_classifier(docs, fit).join(rest, "doc_id").select("keep", "quality").collect()
    assert sum(r.keep == (r.quality == 1) for r in got) >= 0.95 * len(got)
    assert all(r.keep for r in got if r.quality == 1)
    got = toxicity.toxicity(docs, fit).select("doc_id", F.col("toxic").alias("found")).join(rest, "doc_id").select("found", "toxic").collect()
    assert sum(r.found for r in got if not r.toxic) <= 0.02 * len(got) and any(r.found for r in got if r.toxic)


def test_ordinal_grades_in_order():
    chance = np.random.default_rng(1)
    cells, values, grade = [], [], []
    for _ in range(600):
        g = int(chance.integers(0, 4))
        cells.append(np.sort(np.concatenate([[g], 100 + chance.choice(50, 5, replace=False)])))
        values.append(np.ones(6, np.float32))
        grade.append(g)
    model = ordinal.fit(ordinal.Features.of(cells, values), np.array(grade), np.ones(600), [0, 1, 2, 5], True, 0.0, 1e-4, 400, 1)
    assert (np.diff(model.thresholds) >= 0).all()
    tails = model.tails(np.array([model.weights[c].sum() for c in cells]))
    assert (np.diff(tails, axis=1) <= 1e-12).all()
    expected = tails @ np.diff(model.grades)
    assert [expected[np.array(grade) == g].mean().round() for g in range(4)] == sorted(expected[np.array(grade) == g].mean().round() for g in range(4))
    assert np.corrcoef(expected, np.array([0, 1, 2, 5])[grade])[0, 1] > 0.9


@pytest.mark.parametrize("ones", [True, False])
def test_gradient_is_that_of_the_likelihood(monkeypatch, ones):
    monkeypatch.setattr(ordinal, "BLOCK", 7)  # many blocks
    chance = np.random.default_rng(2)
    cells = [np.sort(chance.choice(12, int(chance.integers(0, 6)), replace=False)).astype(np.int32) for _ in range(40)]
    values = None if ones else [chance.random(len(c)).astype(np.float32) for c in cells]
    grade, weight = chance.integers(0, 4, 40), chance.random(40)
    w, cuts = chance.standard_normal(12), np.sort(chance.standard_normal(3))
    x = ordinal.Features.of(cells, values)
    loss, g, gc = ordinal.loss_and_gradient(x, grade, weight, w, cuts)
    brute = 0.0
    for k in range(40):
        score = sum(w[c] * (1 if ones else values[k][j]) for j, c in enumerate(cells[k]))
        upto = [0.0, *(1 / (1 + np.exp(-(t - score))) for t in cuts), 1.0]
        brute -= weight[k] * np.log(upto[grade[k] + 1] - upto[grade[k]])
    assert loss == pytest.approx(brute)
    for step, gradient, at in ((1e-6, g, w), (1e-6, gc, cuts)):
        for j in range(len(at)):
            moved = at.copy()
            moved[j] += step
            later = ordinal.loss_and_gradient(x, grade, weight, moved if at is w else w, moved if at is cuts else cuts)[0]
            assert (later - loss) / step == pytest.approx(gradient[j], abs=1e-4)


def test_word_features_are_those_of_plain_python():
    """Cells are hashes, so equal cells are checked against equal words and stems, in letters only and small."""
    import pyarrow as pa

    texts = ["Über die Brücke, don't!", "über DIE", "", None, "stemming stemmed stem", "stemming", "a1b2 a b"]
    got = [set(cell[first[k] : first[k + 1]].tolist()) for rows, first, cell, _ in ordinal.features(pa.array(texts), True) for k in range(rows)]

    def said(text):
        text = re.sub(r"[\x00-\x40\x5b-\x60\x7b-\x7f]", " ", "".join(c.lower() if c.isascii() or c in "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ" else c for c in text or ""))
        words = {w.encode() for w in text.split()}
        return {("word", w) for w in words} | {("stem", w[:k]) for w in words for k in (4, 5, 6) if len(w) > k}

    want = [said(t) for t in texts]
    for a in range(len(texts)):
        assert len(got[a]) == len(want[a])
        for b in range(len(texts)):
            assert len(got[a] & got[b]) == len(want[a] & want[b])


def test_repeated_ids_do_not_change_the_model(spark, texts):
    two = spark.createDataFrame([(k, k % 2, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows([*texts, "zzz another text of the first id"], [*range(len(texts)), 5]), SCHEMA)
    models = [ordinal.train(docs.repartition(n), two, "quality", 100, False, 0.0, 1e-4, rounds=5, least_docs=1) for n in (1, 7)]
    assert (models[0].weights == models[1].weights).all() and (models[0].thresholds == models[1].thresholds).all()


def test_classifiers_on_odd_tables(spark, texts):
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(3, 1, 0), (4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(r.keep for r in quality.quality_classifier(docs, none).collect())
    assert not any(r.toxic for r in toxicity.toxicity(docs, none).collect())
    assert all(r.keep and r.expected_grade == 1 for r in quality.quality_classifier(docs, one).collect())
    two = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(20)], "doc_id long, quality int, toxic int")
    clash = docs.withColumns({"keep": F.lit("x"), "expected_grade": F.lit("y"), "toxic": F.lit("z")})
    got = quality.quality_classifier(clash, two)
    assert got.count() == len(texts) and dict(got.dtypes)["keep"] == "boolean" and dict(got.dtypes)["expected_grade"] == "double"
    assert dict(toxicity.toxicity(clash, two).dtypes)["toxic"] == "boolean"
    assert quality.quality_classifier(spark.createDataFrame([], SCHEMA), two).count() == 0


def test_scores_do_not_depend_on_the_neighbours(spark, texts):
    two = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(20)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    for words_only, column in ((True, "toxic"), (False, "quality")):
        model = ordinal.train(docs, two, column, 100, words_only, 0.0, 1e-4, rounds=20, least_docs=1)
        alone = {r.doc_id: r.tail_probability for r in ordinal.score(docs.repartition(len(texts)), model, 1).collect()}
        together = {r.doc_id: r.tail_probability for r in ordinal.score(docs.coalesce(1), model, 1).collect()}
        assert alone.keys() == together.keys()
        assert all(abs(alone[k] - together[k]) < 1e-9 for k in alone)


# ---------------------------------------------------------------- fingerprints
def leaf(block):
    import xxhash

    return f"{xxhash.xxh64_intdigest(block.encode(), 42):016X}"


def digest(text, n):
    return hashlib.sha256(text.encode()).hexdigest()[:n]


def written_again(text):
    """The tree from the text: blocks of eight words, paragraphs, sections, root, each node from its children's."""
    paragraphs = []
    for line in re.findall(r"[^\n]*\n|[^\n]+", text):
        words = re.findall(r"[^ \n]*[ \n]|[^ \n]+", line)
        paragraphs.append(" ".join(leaf("".join(words[k : k + 8])) for k in range(0, len(words), 8)))
    sections, held = [], []
    for p in paragraphs:
        node = digest(p, 24)
        held.append((node, p))
        if node[0] in "048c":
            sections.append(held)
            held = []
    sections += [held] if held else []
    written = [digest("".join(f"{n}," for n, _ in s), 24) + ":" + "".join(f"{n}={p}," for n, p in s) for s in sections]
    return "/".join([digest(",".join(x[:24] for x in written), 32), *written])


def shared_leaves(one, other):
    if one[:32] == other[:32]:
        return 1.0
    a, b = (set(re.findall(r"(?<=[= ])[0-9A-F]{16}(?=[ ,])", x)) for x in (one, other))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_fingerprints(spark, texts):
    ids = list(range(len(texts)))
    ids[4] = None
    docs = spark.createDataFrame(rows(texts, ids), SCHEMA).repartition(3)
    got = fingerprint.document_fingerprints(docs).collect()
    assert len(got) == len(texts)
    order = sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is None, -(x[0] or 0)))
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        r = next(r for r in got if r.doc_id == i)
        assert (r.n_chars, r.edited_text) == (len(t), t[: len(t) - cut] + following[:cut])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (r.edited_text == t)
        assert r.near_next == shared_leaves(r.fingerprint, written_again(following))
    by_text, by_print = defaultdict(set), defaultdict(set)
    for r in got:
        by_text[r.text].add(r.fingerprint)
        by_print[r.fingerprint[:32]].add(r.text)
        assert r.fingerprint == written_again(r.text) and r.edited_fingerprint == written_again(r.edited_text)
        assert r.near_edited == shared_leaves(r.fingerprint, r.edited_fingerprint)
    assert all(len(x) == 1 for x in by_text.values()) and all(len(x) == 1 for x in by_print.values())


def test_fingerprints_repeated_rows_one_row_and_none(spark):
    two = fingerprint.document_fingerprints(spark.createDataFrame(rows(["abcdef", "abcdef", "uvw"], [5, 5, 5]), SCHEMA)).collect()
    assert sorted((r.text, r.edited_text) for r in two) in ([("abcdef", "abcdab"), ("abcdef", "abcduv"), ("uvw", "uva")], [("abcdef", "abcdab"), ("abcdef", "abcdab"), ("uvw", "uva")])
    alone = fingerprint.document_fingerprints(spark.createDataFrame(rows(["abcdef"]), SCHEMA)).collect()
    assert [r.edited_text for r in alone] == ["abcdab"]
    assert fingerprint.document_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_fingerprints_of_many_rows_with_one_id_or_none(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_CHARS", 200)
    table = [(5, f"five {k}") for k in range(60)] + [(None, f"none {k}") for k in range(60)] + [(k, f"own {k}") for k in range(10, 70)]
    docs = spark.createDataFrame(rows([t for _, t in table], [i for i, _ in table]), SCHEMA).repartition(3)
    got = fingerprint.document_fingerprints(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in table)
    following = {}  # each row's next text fits what it was given
    hashed = dict(docs.select("text", F.xxhash64("text")).collect())
    order = sorted(table, key=lambda x: (x[0] is None, -(x[0] or 0), hashed[x[1]]))
    for k, (i, t) in enumerate(order):
        following[i, t] = order[(k + 1) % len(order)][1]
    for r in got:
        cut = len(r.text) // 3
        assert r.edited_text == r.text[: len(r.text) - cut] + following[r.doc_id, r.text][:cut]


def test_trees_locate_an_edit(spark):
    lines = [f"line {k} has some words of its own, number {k * 7} and {k * 13} which is enough for three blocks of eight words{k}" for k in range(40)]
    changed = [*lines[:20], lines[20].replace("three blocks", "four blocks"), *lines[21:]]
    added = [*lines[:20], "an inserted line", *lines[20:]]
    table = spark.createDataFrame([("\n".join(lines), "\n".join(x)) for x in (lines, changed, added)] + [("", "a"), ("a", "")], "a string, b string")
    pair = table.select("a", "b", fingerprint.fingerprint(F.col("a")).alias("f"), fingerprint.fingerprint(F.col("b")).alias("g"))
    got = pair.select("f", "g", fingerprint.locate(F.col("f"), F.col("g")).alias("here"), fingerprint.locate(F.col("g"), F.col("f")).alias("there")).collect()

    def paragraphs(tree):
        return [[p.split("=")[1].split(" ") for p in s.split(":")[1].split(",") if p] for s in tree.split("/")[1:]]

    assert got[0].here == got[0].there == []
    for r, where in ((got[1], "here"), (got[1], "there"), (got[2], "there")):
        one, other = (r.f, r.g) if where == "here" else (r.g, r.f)
        assert len(r[where]) == 1
        s, p, k = r[where][0]
        known = {x for section in paragraphs(other) for para in section for x in para}
        assert paragraphs(one)[s][p][k] not in known
        assert [x for section in paragraphs(one) for para in section for x in para if x not in known] == [paragraphs(one)[s][p][k]]
    assert [tuple(x) for x in got[3].there] == [(0, 0, 0)] and [tuple(x) for x in got[3].here] == [(None, None, None)]
    assert all(x.block is None for x in got[2].here)  # nothing is lacking there


# ---------------------------------------------------------------- packing
def test_ids_are_those_of_the_tokenizers_library(texts):
    import duckdb
    import pyarrow as pa
    from tokenizers import Tokenizer

    real = Tokenizer.from_file(tokenizer_path())
    encoder = packing._Encoder(tokenizer_path())
    odd = ["a <|endoftext|> b", "x  y  z", "\t\n a\r\n\r\n  b ", "", "日本語 テスト 123 don't I'LL  ", "a\x1cb c  d", "  ", " a", "a\x85 b　", "🙂 🙂🙂", "ß'S 1st", None]
    some = [*odd, *texts, *(r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall())]
    got = [ids.tolist() for _, data, offsets in common.utf8_slices(pa.array(some), 50_000) for ids in encoder.rows(data, offsets)]
    assert got == [x.ids for x in real.encode_batch([x or "" for x in some], add_special_tokens=False)]


def check_packing(got, capacity):
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_places_every_piece_once(spark, texts):
    docs = spark.createDataFrame(rows([*texts, *texts[:12]]), SCHEMA)
    got = packing.best_fit_packing(docs, tokenizer_path(), capacity=64, shard_size=30).collect()
    check_packing(got, 64)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    assert len(by_doc) == docs.count()
    for parts in by_doc.values():
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert all(r.length == 64 for r in parts[1:])
        assert [r.start for r in parts] == [sum(x.length for x in parts[:k]) for k in range(len(parts))]
        assert np.frombuffer(parts[-1].ids, "<u4")[-1] == 0
    assert sum(r.doc_id == 0 for r in got) == 1


def test_packing_is_near_the_bound_and_refuses_bad_lengths(spark):
    chance = random.Random(2)
    lengths = [chance.choice([chance.randint(1, 100), chance.randint(20, 60)]) for _ in range(900)]
    got = packing.pack(spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "k int, length long"), 100, shard_size=300).collect()
    assert sorted(r.k for r in got) == list(range(900))
    assert check_packing(got, 100) <= 1.05 * packing.lower_bound(lengths, 100) + 3
    assert packing.pack(spark.createDataFrame([], "k int, length long"), 100).collect() == []
    with pytest.raises(Exception, match="length must be"):
        packing.pack(spark.createDataFrame([(1, 101)], "k int, length long"), 100).collect()


def test_evolution_improves_or_keeps():
    chance = random.Random(4)
    lengths = [chance.randint(15, 60) for _ in range(200)]
    first = packing.evolve(lengths, 100, [], 1, 0, 4)
    later = packing.evolve(lengths, 100, first, 1, 40, 4)
    assert max(later[0]) <= max(first[0])
    for places in later:
        fill = defaultdict(int)
        for n, b in zip(lengths, places, strict=True):
            fill[b] += n
        assert max(fill.values()) <= 100


# ---------------------------------------------------------------- mixing
def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


@pytest.mark.parametrize("sources", [["a", "b", None], ["a", "b", "c", "d", "é", "z"], ["big", "big", "big", "big", "big", "tiny"], ["one"]])
def test_mixing(spark, sources):
    chance = random.Random(8)
    docs = [(k, " ".join(["w"] * chance.choice([0, 1, 5, 20, 60])) if k % 17 else None, sources[chance.randrange(len(sources))]) for k in range(400)]
    df = spark.createDataFrame([(i, t, "x", s, None, 1, 2, 3) for i, t, s in docs], SCHEMA)
    got = mixing.mix_sources(df).collect()
    assert sorted(r.doc_id for r in got) == list(range(400))
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t, s in docs:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    for r in got:
        assert r.doc_size == len(WORD.findall(docs[r.doc_id][1] or "")) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.doc_size
    for s in want:
        assert abs(taken[s] - want[s]) <= 31
    again = {r.doc_id: r.copies for r in mixing.mix_sources(df.repartition(5)).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_mixing_repeated_rows_and_none(spark):
    df = spark.createDataFrame([(1, "a b", None, "s", None, 1, 2, 3)] * 5 + [(None, "c", None, None, None, 1, 2, 3)], SCHEMA)
    got = mixing.mix_sources(df).collect()
    assert len(got) == 6 and abs(sum(r.copies * r.doc_size for r in got) - got[0].source_size - 1) <= 2
    # equal rows, with and without an id: as many as the target needs, within one document
    same = [(1, "a b c", None, "s", None, 1, 2, 3)] * 600 + [(None, "a b c d", None, "t", None, 1, 2, 3)] * 500 + [(7, "x " * 40, None, "u", None, 1, 2, 3)] * 300
    got = mixing.mix_sources(spark.createDataFrame(same, SCHEMA).repartition(3)).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.copies * r.doc_size
        target[r.source] = r.target
    assert len(got) == 1400 and all(abs(taken[s] - target[s]) <= {"s": 3, "t": 4, "u": 40}[s] for s in target)
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    empty = mixing.mix_sources(spark.createDataFrame([(1, "", None, "s", None, 1, 2, 3), (2, None, None, "t", None, 1, 2, 3)], SCHEMA)).collect()
    assert [r.copies for r in empty] == [0, 0]


@pytest.mark.parametrize("power", [0.0, 0.5, 1.0])
def test_pareto_sampling_takes_documents_by_their_odds(spark, power):
    """Shares of taken documents by size over many seeds are near size ** power, and near 1 for the certain ones."""
    sizes = [2, 8, 32, 128]
    docs = [(k, " ".join(["w"] * sizes[k % 4]), "x", "ab"[k % 8 == 7], None, 1, 2, 3) for k in range(640)]
    df = spark.createDataFrame(docs, SCHEMA).coalesce(2).cache()
    hits, of = defaultdict(int), defaultdict(int)
    for seed in range(4):
        for r in mixing.mix_sources(df, weights=(1, 3), power=power, seed=seed).collect():
            if r.source == "a":
                hits[r.doc_size] += r.copies
                of[r.doc_size] += 1
                ratio = r.target / r.source_size
    share = {n: hits[n] / of[n] for n in sizes}
    assert 0 < ratio < 1
    words = {n: of[n] * n for n in sizes}
    assert abs(sum(share[n] * words[n] for n in sizes) / sum(words.values()) - ratio) < 0.02
    step = {n: 2 ** (int(16 * np.log2(n)) / 16 * power) for n in sizes}
    scale = ratio * sum(words.values())
    certain = []
    while True:  # brute force of the inclusion probabilities
        rest = [n for n in sizes if n not in certain]
        c = (scale - sum(words[n] for n in certain)) / sum(words[n] * step[n] for n in rest)
        over = [n for n in rest if c * step[n] > 1]
        if not over:
            break
        certain += over
    for n in sizes:
        assert abs(share[n] - (1 if n in certain else c * step[n])) < 0.12


def test_sha_of_edited_text_is_utf8(spark):
    r = fingerprint.document_fingerprints(spark.createDataFrame(rows(["éàüöß🙂"]), SCHEMA)).select("edited_text", F.sha2("edited_text", 256).alias("s")).first()
    assert r.s == hashlib.sha256("éàüöéà".encode()).hexdigest() and r.edited_text == "éàüöéà"
