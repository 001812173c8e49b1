"""The ten operators on hand rows: nulls, empty and long texts, ties, repeats, empty tables, clashes."""

import hashlib
import pickle
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from compare import differences, duck
from veracast.llm import (
    decontaminate,
    encode,
    graded_quality,
    language_id,
    language_model,
    mixture,
    near_duplicates,
    quality_rules,
    secret_scan,
    sequences,
    token_counts,
)
from veracast.llm.queries import labelled_findings

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "The same words here, again and again.", "en", "src1", 1, "a"),
    (1, "The same words here, again and again.", "en", "src1", 1, "a"),
    (2, None, None, None, None, None),
    (None, "", "en", "src0", 0, "b"),
    (None, LONG, "en", "src0", 0, "b"),
    (3, " \t\r\n ", "de", "odd", 0, "b"),
    (4, "ÉTÉ à la plage. <|endoftext|> 12!!", "fr", None, 9, "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["op1_decontaminate", "op5_quality_rules", "op6_mixture"])
def test_matches_duckdb(spark, name):
    assert differences(queries()[name](spark, SMALL), duck(SMALL), oracle_sql()[name]) == []


def test_windows_found_as_by_brute_force(spark, docs, none):
    items = [("b", "x " * 3 + "A b c d e f g h i j k"), ("a", "same words"), ("n", None), (None, "plage")]
    items += [("b", "same words"), ("e", "..!")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = decontaminate.contamination(docs, bench).select("doc_id", "n_words", "_hits").collect()
    assert len(rows) == len(ROWS)
    for row, (_, text, *_) in zip(rows, ROWS):
        words = decontaminate.alnum_words(text)
        spots, names = set(), set()
        for name, body in items:
            for window in decontaminate.windows_of(decontaminate.alnum_words(body)):
                for at in range(len(words) - len(window) + 1):
                    if tuple(words[at : at + len(window)]) == window:
                        spots.update(range(at, at + len(window)))
                        names.add(name)
        got = row["_hits"]
        assert got["n_words"] == len(words)
        assert {i for s in got["spans"] for i in range(s["first"], s["last"])} == spots
        assert got["items"] == sorted(names - {None})
    # In blocks of the benchmark, the same.
    blocks = decontaminate.contamination(docs, bench, block_bytes=8).select("_hits").collect()
    assert sorted(r["_hits"] for r in blocks) == sorted(r["_hits"] for r in rows)
    assert decontaminate.contamination(none, bench).count() == 0
    free = decontaminate.contamination(docs, bench.limit(0)).where(F.size("_hits.spans") > 0)
    assert free.count() == 0


def test_phrases_are_longest_matches():
    training = {"x": [b"abracadabra"], "y": [b"banana bandana"]}
    parser = language_id.Parser(*language_id.Parser.tables(training))

    def phrases(text, known):
        count, at = 0, 0
        while at < len(text):
            end = at + 1
            while end < len(text) and any(text[at : end + 1] in k for k in known):
                end += 1
            count, at = count + 1, end
        return count

    texts = [b"abracad", b"banana", b"zzz", b"nabab dan", b"", b"abra" * 600]
    want = [
        [sum(phrases(t[i : i + language_id.BLOCK], training[k]) for i in range(0, len(t), language_id.BLOCK)) for k in "xy"]
        for t in texts
    ]
    assert parser.phrases(texts).tolist() == want


def test_language_tables_stay_off_the_driver(spark):
    """What the driver learns and sends is the sample of bytes, not the tables made of it."""
    many = "abcdefghijklmnopqrstuvwxyz"
    rows = [(" ".join(many[i % 26] + many[(i * j) % 26] for j in range(200)), f"l{i % 2}") for i in range(60)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"), most_bytes=6_000)
    assert len(pickle.dumps(model)) < 2 * 6_000 + 4_000
    assert [name for name, _ in model] == ["l0", "l1"]
    assert all(5_000 < sum(map(len, parts)) <= 6_000 for _, parts in model)


def test_language_accuracy_and_edges(spark, docs, none):
    found = queries()["op2_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(truth, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()
    model = language_id.train(docs)
    rows = language_id.identify(docs, model).select("text", "_lang.*").collect()
    assert [r["lang"] == "und" for r in rows] == [not language_id.has_letter(r["text"]) for r in rows]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert language_id.identify(none, model).count() == 0
    untrained = language_id.identify(docs, language_id.train(none))
    assert {r[0] for r in untrained.select("_lang.lang").collect()} == {"und"}


def _encoded(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encode.tokenizer_path()).encode(text, add_special_tokens=False)


def test_token_files_round_trip(spark, docs, none, tmp_path):
    manifest = sequences.write_sequences(docs, str(tmp_path / "s"), length=16, shard_bytes=1000)
    rows = sorted(sequences.read_documents(manifest).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == [None, None, 1, 1, 2, 3, 4]
    want = {}
    for doc_id, text, *_ in ROWS:
        own = np.array([*_encoded(text or "").ids, 2], "<u4")
        want.setdefault(doc_id, []).append((len(own), zlib.crc32(own.tobytes())))
    start = 0
    for r in rows:
        assert (r["n_tokens"], r["ids_crc32"]) in want[r["doc_id"]] and r["start"] == start
        start += r["n_tokens"]
    path = manifest.orderBy(F.desc("tokens")).first()["path"].removeprefix("file://")
    shard = sequences.SequenceFile(pa.memory_map(f"{path}.ids.arrow"))
    assert sum(shard[i][1].true_count for i in range(len(shard))) == max(
        r["tokens"] for r in manifest.collect()
    )
    assert sequences.read_documents(sequences.write_sequences(none, str(tmp_path / "n"))).count() == 0


def test_encoder_equals_whole_text_encoding():
    texts = [t for _, t, *_ in ROWS] + ["It's.  x,y a.b! ΣΑΣ. Straße; été", "don't, DON'T."]
    for offsets in (False, True):
        code = encode.RunEncoder(encode.tokenizer_path(), offsets).encode(pa.array(texts))
        at = 0
        for text, n in zip(texts, code.counts):
            whole = _encoded(text or "")
            assert code.ids[at : at + n].tolist() == whole.ids
            if offsets:
                spans = list(zip(code.first[at : at + n].tolist(), code.last[at : at + n].tolist()))
                assert spans == whole.offsets
            at += n


def _components(texts, width, percent):
    sets = []
    for text in texts:
        w = near_duplicates_words(text)
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= percent * len(a | b):
                label = [label[j] if x == label[i] else x for x in label]
    return label, sets


def near_duplicates_words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_near_duplicates_equal_brute_force(spark, docs, none):
    draw = np.random.default_rng(1)
    base = [f"v{i}" for i in draw.integers(0, 500, 60)]
    texts = [None, "", "One", "one", "a b", "A  b", "x y z"]
    for _ in range(60):
        words = list(base)
        for at in draw.integers(0, 60, int(draw.integers(0, 8))):
            words[at] = f"v{draw.integers(0, 500)}"
        texts.append(" ".join(words))
    rows = [(i, t, i) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_shingles long")
    label, sets = _components(texts, 2, 80)
    found = near_duplicates.near_duplicates(table, shingle=2).collect()
    got = {r["doc_id"]: r["_near"] for r in found}
    least = {x: min(i for i, y in enumerate(label) if y == x) for x in label}
    for i in range(len(texts)):
        assert got[i]["component_id"] == least[label[i]] and got[i]["n_shingles"] == len(sets[i])
        assert got[i]["first"] == (i == least[label[i]])
    again = near_duplicates.near_duplicates(docs).select("doc_id", "n_words", "_near.*").collect()
    assert len(again) == len(ROWS)
    assert sorted(r["first"] for r in again if r["doc_id"] == 1) == [False, True]
    assert near_duplicates.near_duplicates(none).count() == 0


def test_near_duplicates_move_texts_once_to_their_rows(spark):
    """Components are named without texts: what is returned joins them to their rows, and nothing else."""
    rows = [(i, " ".join(f"w{i // 2}_{k}" for k in range(30)) + f" end{i % 2}", "x") for i in range(8)]
    docs = spark.createDataFrame([*rows, (None, rows[0][1], "y"), (9, None, "z")], "doc_id long, text string, lang string")
    found = near_duplicates.near_duplicates(docs)
    got = {(r["doc_id"], r["lang"]): r["_near"] for r in found.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = found.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert text.count("SortMergeJoin") == 1 and text.count("Exchange hashpartitioning") == 2
    assert len(got) == 10 and got[None, "y"]["component_id"] == 0
    assert {i: got[i, "x"]["component_id"] for i in range(8)} == {i: i // 2 * 2 for i in range(8)}
    assert sorted(k[0] for k, near in got.items() if near["first"]) == [0, 2, 4, 6, 9]


@pytest.mark.parametrize("hashes, seed", [(256, 5), (2048, 6)])
def test_signatures_keep_links_of_small_sets(hashes, seed):
    draw, lost = np.random.default_rng(0), 0
    signer, most = near_duplicates.Signer(hashes, seed), near_duplicates.most_differing(80, hashes)
    for _ in range(1000):
        full = draw.integers(0, 1 << 63, 5, np.uint64) * np.uint64(2)
        p, q = near_duplicates._planes(np.array([signer.minima(full), signer.minima(full[1:])])).view(np.uint64)
        bits = (p ^ q).reshape(2, -1)
        lost += int(np.bitwise_count(bits[0] | bits[1]).sum()) > most
    assert lost == 0


def test_quality_rules_edges(docs, none):
    judged = quality_rules.judge(docs)
    assert judged.drop("_quality").exceptAll(docs).count() == 0 and judged.count() == len(ROWS)
    assert quality_rules.judge(none).count() == 0
    empty = quality_rules.judge(docs).where("text is null").select("_quality.*").first()
    assert (empty["n_words"], empty["word_chars"], empty["kept"]) == (0, 0, False)


def test_mixture_budgets(spark, docs, none):
    mixed = mixture.mix(docs, F.lit("d"), {}, epochs=2).select("doc_id", "_mix.*")
    rows = mixed.collect()
    assert len(rows) == len(ROWS) and all(0 <= r["copies"] <= 2 for r in rows)
    # Equal rows are taken together.
    assert len({r["copies"] for r in rows if r["doc_id"] == 1}) == 1
    assert mixture.mix(none, F.lit("d"), {}).count() == 0
    leaves = [("a", "x", "s", 1, 3, 1, 10), ("a", "x", "t", 1, 3, 1, 90), ("a", "y", "s", 1, 1, 1, 5), ("b", "x", "s", 1, 1, 1, 500)]
    names = "domain string, lang string, source string, w_domain int, w_lang int, w_source int, tokens long"
    out = mixture.budgets(spark.createDataFrame(leaves, names), 200, 1).collect()
    got = {(r["b_domain"], r["b_lang"], r["b_source"]): r["budget"] for r in out}
    # 100 for each domain; y can use 5, its sibling takes the rest; s can use 10, t takes the rest.
    assert got == {("a", "x", "s"): 10, ("a", "x", "t"): 85, ("a", "y", "s"): 5, ("b", "x", "s"): 100}


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_tokens_of_sections_equal_brute_force(docs, none, rule):
    found = token_counts.section_tokens(docs, rule=rule, end=r"[.!?\ne]").collect()
    assert len(found) == len(ROWS)
    for row in found:
        text, sections = row["text"] or "", row["_sections"]
        assert [s["start"] for s in sections] == [0, *[s["stop"] for s in sections]][: len(sections)]
        spans = _encoded(text).offsets if text else []
        assert sum(s["n_tokens"] for s in sections) == len(spans)
        if len(text) < 1000:
            counts = [0] * len(sections)
            for a, b in spans:
                inside = [max(0, min(b, s["stop"]) - max(a, s["start"])) for s in sections]
                hit = [i for i, n in enumerate(inside) if n]
                best = max(hit, key=lambda i: inside[i])
                counts[{"first": hit[0], "last": hit[-1], "most": best}[rule]] += 1
            assert [s["n_tokens"] for s in sections] == counts
    assert token_counts.section_tokens(none).count() == 0


def test_secrets_kept_and_lookalikes_dropped(spark, none):
    rows, labels = [], []
    for i in range(60):
        key = hashlib.sha1(str(i).encode()).hexdigest()
        body = f'the token = "{key}" is' if i % 2 else f"see build-2024-number-{i}-of-things-{i} at www"
        rows.append((i, body, "src1"))
        labels.append(i % 2)
    table = spark.createDataFrame([*rows, (None, None, None)], "doc_id long, text string, source string")
    found = secret_scan.candidates(table)
    labelled = found.withColumn("label", (F.col("key") % 2).cast("int"))
    out = secret_scan.scan(table, secret_scan.train(labelled)).collect()
    assert {r["key"] for r in out} == {i for i, n in enumerate(labels) if n}
    assert secret_scan.scan(table, secret_scan.train(labelled.limit(0))).count() == 0
    assert secret_scan.scan(none, None).count() == 0


def test_secret_labels_and_sample_of_both_kinds(spark):
    key = hashlib.sha1(b"k").hexdigest()
    texts = {
        1: f'TOKEN = "{key.upper()}"', 2: f"API_KEY={key}", 3: f"token: {key}", 4: f"see {key} there",
        5: f"sha1: {key}", 6: "padded-with-2-at-the-end==", 7: f'token = "{key}"',
    }
    schema = "doc_id long, text string, source string"
    table = spark.createDataFrame([(i, t, "s") for i, t in texts.items()], schema)
    found = {r["key"]: r for r in labelled_findings(table).collect()}
    assert {i: r["label"] for i, r in found.items()} == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 1}
    assert (found[2]["value"], found[2]["before"]) == (key, "API_KEY=")
    assert found[6]["value"] == texts[6]
    # One secret among many others is in a small sample, and one kind of label alone is no report of all.
    many = [(i, f"see build-2024-number-{i}-of-things at www", "s") for i in range(10, 300)]
    mixed = spark.createDataFrame([(1, texts[1], "s"), *many], schema)
    model = secret_scan.train(labelled_findings(mixed), most=20)
    assert not isinstance(model.forest, float)
    assert [r["key"] for r in secret_scan.scan(mixed, model, 0.3).collect()] == [1]
    none_secret = secret_scan.train(labelled_findings(mixed.where("doc_id > 1")))
    assert secret_scan.scan(mixed, none_secret).count() == 0


def test_secret_features_come_from_the_corpus(spark):
    body = "token rezilu rezilu build xq xq xq " + "ab " * 50
    table = spark.createDataFrame([(1, body, "s")], "doc_id long, text string, source string")
    corpus = secret_scan.corpus_of(table)
    values = ["rezilu-000000000000", "bolani-000000000000", "RezilurezILU0000000", "abababababababab0", "xqxqxqxqxqxqxqxq0"]
    schema = "value string, path string, before string, after string"
    found = spark.createDataFrame([(v, "s", "", "") for v in values], schema)
    rows = [("a", "p", "the key", "", 1, 0), ("b", "p", "key", "", 1, 1), ("c", None, "log", "key", 0, 1), ("d", "q", None, None, 0, 2)]
    learnt = secret_scan.learn_items(spark.createDataFrame(rows, schema + ", label int, fold int"))
    got = {r["value"]: r for r in secret_scan.features(found, corpus, learnt).collect()}
    assert all(got[v][c] == 0 for v in values for c in ("beside_most", "beside_mean", "path_odds"))
    # Words beside and paths stand for what labels say of them; a finding's own fold is left out.
    judged = [("x" * 16, None, "the key", "log"), ("y" * 16, "p", "unseen", None)]
    odds = {r["value"][0]: r for r in secret_scan.features(spark.createDataFrame(judged, schema), corpus, learnt).collect()}
    of = lambda yes, no: np.log((yes + 1) / (no + 1))
    assert odds["x"]["beside_most"] == pytest.approx(of(1, 0)) and odds["x"]["path_odds"] == pytest.approx(of(0, 1))
    assert odds["x"]["beside_mean"] == pytest.approx((of(1, 0) + of(2, 1) + of(0, 1)) / 3)
    assert odds["y"]["beside_most"] == 0 and odds["y"]["path_odds"] == pytest.approx(of(2, 0))
    folded = spark.createDataFrame([("z" * 16, "p", "key", "", 1)], schema + ", fold int")
    own = secret_scan.features(folded, corpus, learnt).first()
    assert own["beside_most"] == pytest.approx(of(1, 0)) and own["path_odds"] == pytest.approx(of(1, 0))
    # Words are those the corpus has, not any with vowels.
    assert got[values[0]]["dictionary"] == pytest.approx(6 / 19) and got[values[1]]["dictionary"] == 0
    # "Rezilurez" and "ILU" are two runs; the corpus has neither.
    assert got[values[2]]["dictionary"] == 0
    # a is followed by b 50 times, x by q 3 times.
    assert got[values[3]]["unlikely"] < got[values[4]]["unlikely"]


def test_grades_are_ordered_and_learnt(spark, docs, none):
    found = queries()["op9_graded_quality"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = found.where("held_out").join(labels, "doc_id")
    clean, toxic = held.where("quality = 1 and toxic = 0"), held.where("toxic = 1")
    assert clean.where("selected").count() >= 0.9 * clean.count()
    assert toxic.where("not selected").count() >= 0.65 * toxic.count()
    model = graded_quality.train(docs, docs.select("doc_id", F.lit(None).cast("int").alias("grade")))
    rows = graded_quality.grade(docs, model).select("_grade.*").collect()
    assert len(rows) == len(ROWS) and not any(r["selected"] for r in rows)
    assert graded_quality.grade(none, model).count() == 0
    # Repeated ratings and rows count once; a long text and one without a rating do no harm.
    rated = spark.createDataFrame([(1, 2), (1, 2), (2, 0), (4, 1), (None, 1), (99, 0)], "doc_id long, grade int")
    weights, thresholds = graded_quality.train(docs, rated)
    assert len(thresholds) == 2 and (np.diff(thresholds) > 0).all() and len(weights) == graded_quality.DIMENSIONS


def test_likelihood_gradient_is_that_of_differences():
    """A fit of few steps lowers the negative log likelihood as its numeric gradient says."""
    draw = np.random.default_rng(5)
    places = [np.unique(draw.integers(0, 12, 6)) for _ in range(60)]
    grades = np.array([min(2, int((p < 6).sum() // 2)) for p in places])

    def loss(weights, thresholds):
        score = np.array([weights[p].sum() * graded_quality._value(np.array([len(p)]))[0] for p in places])
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        up = 1 / (1 + np.exp(-(edges[grades + 1] - score)))
        low = 1 / (1 + np.exp(-(edges[grades] - score)))
        return -np.log(up - low).mean()

    free = graded_quality.fit(places, grades, steps=1500, rate=0.02, l2=0.0)
    here = loss(*free)
    assert here < loss(np.zeros(graded_quality.DIMENSIONS), free[1])
    # At the optimum no single change of a weight or threshold improves it.
    for k in range(12):
        for step in (-0.05, 0.05):
            other = free[0].copy()
            other[k] += step
            assert loss(other, free[1]) > here - 1e-4
    for k in range(2):
        for step in (-0.05, 0.05):
            other = free[1].copy()
            other[k] += step
            assert loss(free[0], other) > here - 1e-4


def test_a_large_leaf_is_cut_where_an_ordered_one_is(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 7 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 5).cast("int")).alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "src1").alias("source"),
    )
    odd = spark.createDataFrame([(None, "a b c", "de", "src2")] * 40, "i long, t string, l string, s string")
    rows = rows.union(odd)

    def taken(most):
        found = mixture.mix(rows, F.lit("d"), {}, (5, 8), epochs=1, rows_a_task=most)
        return sorted((str(r["doc_id"]), r["text"], r["_mix"]["copies"], r["_mix"]["leaf_budget"]) for r in found.collect())

    one = taken(10_000)
    assert {r[2] for r in one} == {0, 1}
    assert taken(3) == taken(100) == one
    # Weight 0 leaves a domain out; all of a leaf fits where the share is the whole.
    whole = mixture.mix(rows, F.lit("d"), {}, (1, 1), epochs=1, rows_a_task=50)
    assert whole.where("_mix.copies = 1").count() == rows.count()


def test_near_duplicates_deal_out_all_band_keys_twice_at_most(spark, monkeypatch):
    """However many rounds follow, they read the keys that several classes share, not all of them."""
    plans, kept = [], near_duplicates.kept

    def recorded(df, what, place=None):
        plans.append((what, df._jdf.queryExecution().optimizedPlan().toString()))
        return kept(df, what, place)

    monkeypatch.setattr(near_duplicates, "kept", recorded)
    words = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(words[:i % 3] + words[3:] + [f"x{i // 3}"])) for i in range(12)] + [(99, "a b c d e f g")]
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    comps = {r["doc_id"]: r["_near"]["component_id"] for r in found.collect()}
    assert comps == {i: 0 for i in range(12)} | {99: 99}
    assert [what for what, plan in plans if "explode(bands" in plan] == ["hubs", "shared"]


def test_language_model_base_and_normalisation(spark, docs, none):
    rows = language_model.score(docs, docs.where("doc_id is not null"), head=4).collect()
    words = lambda t: [*near_duplicates_words(t), ""]
    train = [w for i, t, *_ in ROWS if i is not None for w in words(t)]
    count = {w: train.count(w) for w in set(train)}
    base = np.log10(len(train) + len(count) + 1)
    assert len(rows) == len(ROWS)
    for r in rows:
        text = next(t for i, t, l, s, n, w in ROWS if (i, s, n, l) == (r["doc_id"], r["source"], r["n_chars"], r["lang"]) and (i is not None or (t == "") == (r["_lm"]["n_tokens"] == 1)))
        own = words(text)
        want = sum(np.log10(count.get(w, 0) + 1) - base for w in own)
        assert r["_lm"]["n_tokens"] == len(own) and r["_lm"]["train_tokens"] == len(train)
        assert r["_lm"]["n_known"] == sum(w in count for w in own)
        assert r["_lm"]["base_score"] == pytest.approx(want)
    assert language_model.score(none, docs).count() == 0
    assert language_model.score(docs, none).count() == len(ROWS)
    only = language_model.score(docs.select("text"), docs.select("text"))
    assert only.columns == ["_lm"] and only.count() == len(ROWS)
    with pytest.raises(ValueError):
        language_model.score(docs.withColumn("_lm", F.lit(1)), docs)


def test_language_model_probabilities_add_up():
    """Over all words, and as plain softmaxes of class and word give them; steps keep that."""
    model = language_model.LogBilinear.start(np.arange(600, 0, -1).astype(float))
    draw = np.random.default_rng(1)
    words, far, near = draw.integers(0, 600, (3, 500))
    squares = [np.zeros(len(t), np.float32) for t in model.tables]
    seen = [np.zeros(len(t), np.float32) for t in model.tables]
    for _ in range(5):
        model.step(words, far, near, draw, squares, seen)
    for context in ((3, 599), (600, 600)):
        logs = model.log_probabilities(np.arange(600), *(np.full(600, c) for c in context))
        assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
        q = np.append(
            model.context[context[0]] @ model.places[: language_model.WIDTH]
            + model.context[context[1]] @ model.places[language_model.WIDTH :],
            1,
        )
        of = lambda x: np.exp(x.astype(float)) / np.exp(x.astype(float)).sum()
        classes = of(model.classes @ q)
        want = np.concatenate([classes[c] * of(model.target[c * 256 : (c + 1) * 256] @ q) for c in range(3)])
        assert np.exp(logs) == pytest.approx(want, rel=1e-3)
    drawn = model.draw_words(np.repeat(np.arange(3), 2000), draw)
    assert (model.of_class[drawn] == np.repeat(np.arange(3), 2000)[:, None]).all()
    first = np.bincount(drawn[:2000].reshape(-1), minlength=256)[:256] / 8000
    assert np.abs(first - model.word_share[:256]).max() < 0.005


def test_language_model_adds_gradients_and_draws_as_plainly_written():
    """Sums by row, few and many to a row, as ``np.add.at`` gives them; draws as a search of the whole line."""
    draw = np.random.default_rng(7)
    for size, n in ((3, 40), (700, 5000), (70_000, 5000), (5, 1)):
        rows = draw.integers(0, size, n) * draw.integers(0, 2, n)
        gradients = draw.normal(size=(n, 3)).astype(np.float32)
        found, times, total = language_model._row_sums(rows, size, lambda at: gradients.take(at, axis=0))
        want = np.zeros((size, 3))
        np.add.at(want, rows, gradients)
        assert sorted(found) == sorted(set(rows.tolist())) and (times == np.bincount(rows)[found]).all()
        assert np.abs(total - want[found]).max() < 1e-3
    model = language_model.LogBilinear.start(1 / np.arange(1.0, 1001) ** 2)
    kind, order = draw.integers(0, 4, 3000), draw.permutation(3000)
    drawn = model.draw_words(kind, np.random.default_rng(9), order)
    share = np.random.default_rng(9).random((3000, language_model.WORD_NOISE))[order]
    plain = np.searchsorted(model._within, model._starts[kind][:, None] + share, "right") - 1
    last = np.minimum((kind + 1) * language_model.CLASS, 1000) - 1
    assert (drawn == np.clip(plain, (kind * language_model.CLASS)[:, None], last[:, None])).all()


def test_language_model_scores_a_token_alike_whatever_is_beside_it():
    """Repeated contexts, lone ones and blocks of any length give the same logarithms, near or far from 0."""
    draw = np.random.default_rng(4)
    for scale in (1, 60):
        model = language_model.LogBilinear.start(np.arange(700, 0, -1).astype(float))
        model.context *= scale
        words, far, near = draw.integers(0, 700, (3, 3000))
        far[::2], near[::2] = 5, 7
        whole = model.log_probabilities(words, far, near)
        assert np.isfinite(whole).all()
        order = draw.permutation(3000)
        for some in (order, order[:1], order[:77], order[500:1301]):
            assert model.log_probabilities(words[some], far[some], near[some]) == pytest.approx(whole[some], rel=1e-9)


def test_language_model_steps_as_plainly_written():
    """Two mini-batches with repeated words, contexts and noise move every table as the plain sums do."""
    size, width, rate = 700, language_model.WIDTH, language_model.RATE
    model = language_model.LogBilinear.start(np.arange(size, 0, -1).astype(float))
    plain = [t.astype(float) for t in model.tables]
    squares, seen = ([np.zeros(len(t), np.float32) for t in plain] for _ in range(2))
    sums, times = ([np.zeros(len(t)) for t in plain] for _ in range(2))
    for seed in (1, 2):
        take, noises = np.random.default_rng(seed), np.random.default_rng(seed + 10)
        words, far, near = (take.integers(0, n, 300) ** 2 // n for n in (size, size + 1, size + 1))
        model.step(words, far, near, np.random.default_rng(seed + 10), squares, seen)
        order = np.argsort(words, kind="stable")
        words, far, near = words[order], far[order], near[order]
        context, target, classes, places = plain
        ones = np.ones((300, 1))
        q = np.hstack([context[far] @ places[:width] + context[near] @ places[width:], ones])
        kind, line = words // language_model.CLASS, np.cumsum(model.class_share)
        noise = np.searchsorted(line, noises.random(language_model.CLASS_NOISE) * line[-1])
        drawn = np.hstack([words[:, None], model.draw_words(kind, noises, order)])
        share = lambda x, log: 1 / (1 + np.exp(log - x))
        g_true = share((q * classes[kind]).sum(1), model.class_noise[kind]) - 1
        g_noise = share(q @ classes[noise].T, model.class_noise[noise])
        g = share((q[:, None] * target[drawn]).sum(2), model.word_noise[drawn])
        g[:, 0] -= 1
        gq = (g_true[:, None] * classes[kind] + g_noise @ classes[noise] + (g[:, :, None] * target[drawn]).sum(1))[:, :width]
        grads = [np.zeros_like(t) for t in plain]
        np.add.at(grads[0], far, gq @ places[:width].T)
        np.add.at(grads[0], near, gq @ places[width:].T)
        np.add.at(grads[1], drawn, g[:, :, None] * q[:, None])
        np.add.at(grads[2], kind, g_true[:, None] * q)
        np.add.at(grads[2], noise, g_noise.T @ q)
        grads[3] = np.vstack([context[far].T @ gq, context[near].T @ gq])
        rows = (np.concatenate([far, near]), drawn.reshape(-1), np.concatenate([kind, noise]), np.arange(2 * width))
        for k in range(4):
            np.add.at(times[k], rows[k], 1)
            sums[k] += (grads[k] ** 2).mean(1)
            plain[k] = plain[k] - rate * grads[k] / np.sqrt(sums[k] + 1e-6)[:, None]
    for k in range(4):
        assert np.abs(model.tables[k] - plain[k]).max() < 1e-3 and (seen[k] == times[k]).all()


def test_language_model_looks_up_several_slices_at_once(spark, monkeypatch):
    """Slices share the index of known words and give what one slice gives; vectors are moved once."""
    words = [f"w{i}" for i in range(300)]
    draw = np.random.default_rng(6)
    texts = pa.array([" ".join(words[i] for i in draw.integers(0, 300, n)) for n in draw.integers(0, 60, 40)] + [None])
    model = language_model.LogBilinear.start(np.arange(201, 0, -1).astype(float))
    shared = SimpleNamespace(value=(model.tables, model.frequency, words[:280], np.arange(280, -1, -1)))
    looked, slices, places = [], language_model.byte_slices, language_model._places
    monkeypatch.setattr(language_model, "_places", lambda *a: looked.append(1) or places(*a))
    scored = language_model._scorer(shared).func
    (whole,) = scored(iter([texts]))
    assert len(looked) == 1
    looked.clear()
    monkeypatch.setattr(language_model, "byte_slices", lambda texts, most: slices(texts, 700))
    n = len(list(slices(texts, 700)))
    (cut,) = scored(iter([texts]))
    assert n > 8 and len(looked) == -(-n // 4)
    for got, want in zip(cut.to_pylist(), whole.to_pylist()):
        rare = [sorted((r["word"], r["times"]) for r in x.pop("rare")) for x in (got, want)]
        assert got == pytest.approx(want, rel=1e-9) and rare[0] == rare[1]
    far, near = model.moved()
    assert far + near[::-1] == pytest.approx(
        model.context @ model.places[: language_model.WIDTH]
        + model.context[::-1] @ model.places[language_model.WIDTH :],
        abs=1e-5,
    )
    assert [len(a) for a in scored(iter([texts.slice(0, 0)]))] == [0]


def test_language_model_learns_and_does_not_follow_splits(spark):
    """Held-out texts of a language with fixed followers score far above the unigram base."""
    draw = np.random.default_rng(2)
    follows = draw.integers(0, 40, (40, 3))
    rows = []
    for i in range(400):
        words = [int(draw.integers(40))]
        for _ in range(60):
            words.append(int(follows[words[-1], draw.integers(3)]))
        rows.append((i, " ".join(f"w{w}" for w in words)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")

    def scores(df):
        found = language_model.score(df, df.where("doc_id % 4 <> 0"), key="doc_id")
        return {r["doc_id"]: r["_lm"] for r in found.collect()}

    one, other = scores(texts.repartition(7)), scores(texts.coalesce(1))
    assert {i: r["score"] for i, r in one.items()} == {i: pytest.approx(r["score"], rel=1e-9) for i, r in other.items()}
    held = [r for i, r in one.items() if i % 4 == 0]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert gain > 0.4 and all(0 < r["n_modelled"] <= r["n_tokens"] for r in held)
    # The score is the sum of the model's own logarithms.
    assert all(r["score"] < 0 for r in one.values())
