"""Every stage of the corpus pipeline against a brute-force version of it, on its own input."""

import re
import zlib
from itertools import pairwise

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from veracast.llm import common, encode
from veracast.llm.quality_rules import PHRASES
from veracast.llm.statements import _op6

SMALL = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _near string, _mix int"


def _line_fails(line):
    tight = "".join(_WORD.findall(line))
    marks = sum(not c.isalnum() and not _is_mark(c) for c in tight)
    separators = sum(c in "|»›•·" for c in line)
    ended = re.search(r"[.!?…:;)\"”'’।॥。！？][\x20\x09-\x0D]*$", line)
    few = len(_WORD.findall(line)) <= 3 and not ended
    return 100 * marks > 20 * len(tight) or separators >= 3 or few or any(p in line.lower() for p in PHRASES)


def _is_mark(c):
    import unicodedata

    return unicodedata.category(c)[0] in "LNM"


def _clean(text):
    """The text's good lines, or None if the document is rejected."""
    words = _WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
    seen = {}
    for k in range(len(words) - 7):
        seen.setdefault(tuple(words[k : k + 8]), []).append(k)
    repeated = {k + o for ks in seen.values() if len(ks) > 1 for k in ks for o in range(8)}
    if len(words) < 20 or 100 * len(repeated) > 30 * len(words):
        return None
    good = [x for x in dict.fromkeys(lines) if not _line_fails(x)]
    left = sum(len("".join(_WORD.findall(x))) for x in good)
    return "\n".join(good) if 100 * left >= 50 * sum(map(len, words)) else None


def _groups(texts):
    """Smallest index of each text's component of links of similarity 0.8 on five-word shingles."""
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    sets = []
    for t in texts:
        w = (t or "").encode().translate(lower).split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def _windows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    wide = min(10, len(words))
    return {tuple(words[i : i + wide]) for i in range(len(words) - wide + 1)} if words else set(), words


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def outputs(spark):
    """Input and written result of each stage on the smallest tables."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        found = common.kept(stage(spark, docs, SMALL), f"test-{name}")
        out[name] = (docs, found)
        docs = found
    return out


def test_quality_rules(outputs):
    given, found = outputs["quality_rules"]
    want = []
    for r in given.collect():
        text = _clean(r["text"])
        if text is not None:
            want.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    assert found.columns == given.columns and 0 < len(want) < given.count()
    assert _rows(found) == sorted(want, key=str)


def test_near_dedup(outputs):
    given, found = outputs["near_dedup"]
    rows = sorted(given.collect(), key=lambda r: r["doc_id"])
    group = _groups([r["text"] for r in rows])
    assert _rows(found) == sorted((tuple(r) for i, r in enumerate(rows) if group[i] == i), key=str)
    assert found.count() < given.count()


def test_decontaminate(spark, outputs):
    given, found = outputs["decontaminate"]
    items = [_windows(r["text"])[0] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = set().union(*items)
    widths = {len(w) for w in windows}

    def hit(text):
        words = _windows(text)[1]
        return any(tuple(words[i : i + n]) in windows for n in widths for i in range(len(words) - n + 1))

    rows = given.collect()
    assert _rows(found) == sorted((tuple(r) for r in rows if not hit(r["text"])), key=str)
    assert any(hit(r["text"]) for r in rows)


def test_mixture(outputs, tmp_path):
    given, found = outputs["mixture"]
    path = str(tmp_path / "documents")
    given.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/*.parquet')")
    taken = con.sql(f"select doc_id from ({_op6((9, 10), 1)}) where copies > 0").fetchall()
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(r[0] for r in taken)
    assert found.columns == given.columns and len(taken) < given.count()


def test_token_files(outputs):
    given, found = outputs["token_files"]
    library, start = Tokenizer.from_file(encode.tokenizer_path()), 0
    rows = sorted(found.collect(), key=lambda r: r["doc_id"])
    docs = sorted(given.collect(), key=lambda r: r["doc_id"])
    assert len(rows) == len(docs)
    for r, d in zip(rows, docs):
        ids = np.array([*library.encode(d["text"], add_special_tokens=False).ids, 2], "<u4")
        assert tuple(r) == (d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_run_is_the_stages_and_leaves_its_result_alone(spark, outputs):
    from veracast.session import shared_folder
    from veracast.sources import store

    folder = f"{shared_folder(spark)}/llm"
    before = set(store.names(spark, folder))
    assert _rows(corpus_pipeline.run(spark, SMALL)) == _rows(outputs["token_files"][1])
    left = {n.rsplit("-", 1)[0] for n in set(store.names(spark, folder)) - before}
    # The token files are a result, too.
    assert left == {"stage-token_files", "sequences"}


def test_odd_rows_in_every_stage(spark):
    text = "\n".join(" ".join(f"quiet{i}word{j}" for j in range(9)) + "." for i in range(4))
    rows = [
        (1, text, "en", "src1", 1, "a", 1), (1, text, "en", "src1", 1, "a", 1), (2, None, None, None, None, None, None),
        (None, text.replace("quiet", "loud"), "en", None, 0, "b", 2), (3, "", "de", "odd", 0, "b", 0),
        (4, " ".join(f"w{i % 977}x{i}" for i in range(60_000)) + ".", "fr", "src2", 9, "c", 3),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES:
        out = common.kept(stage(spark, docs, SMALL), f"odd-{name}")
        if name != "token_files":
            assert out.columns == docs.columns
        want = {"quality_rules": [None, 1, 1, 4], "near_dedup": [None, 1, 4]}.get(name)
        if want:
            assert sorted((r["doc_id"] for r in out.collect()), key=str) == sorted(want, key=str)
        docs = out
    assert out.where(F.col("doc_id") == 4).count() <= 1
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.kept(stage(spark, docs, SMALL), f"none-{name}")
        assert docs.count() == 0
