"""Language identification by cross-parsing entropy.

A text is parsed against each language's training text into the longest phrases that the training
text contains; the number of phrases estimates the cross entropy, and the language with the fewest
normalised phrases wins. A suffix automaton of the training text finds the phrases: one state change
a byte while the phrase goes on, a restart from the root where it ends.

Letters are lower-cased, all else becomes one space, and UTF-8 bytes are parsed, so an alphabet is
small whatever the script. Texts are parsed in blocks of ``BLOCK`` bytes, all blocks of a batch and
all languages in step: one table look-up per byte and language gives the next state and whether a
phrase ended. Each block's last phrase counts as ended.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from veracast.llm.common import arrow_type, refuse_taken

# The training sample of each language: at most so many rows, bytes, and bytes from one row.
ROWS_PER_LANGUAGE = 200
LANGUAGE_BYTES = 60_000
TEXT_BYTES = 1_500
# The rows of a language are first ranked in so many groups.
_SALTS = 64
BLOCK = 1024
_SLICE_BYTES = 6 << 20
RESULT = "lang string, score double"
# Each language with its training texts.
Sample = tuple[tuple[str, tuple[bytes, ...]], ...]
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """Lower-case letters with single spaces between them, as UTF-8."""
    if not text:
        return b""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the root."""
    nexts, link, length = [{}], [-1], [0]
    last = 0
    for c in text:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


class Parser:
    """Counts phrases of many texts against all languages at once."""

    def __init__(self, langs: list[str], sizes: list[int], symbol: np.ndarray, steps: np.ndarray, roots: np.ndarray):
        self.langs, self.sizes, self.symbol, self.steps, self.roots = langs, sizes, symbol, steps, roots

    @classmethod
    def tables(cls, training: dict[str, list[bytes]]) -> tuple:
        """Step table of all automata. An entry is (next state * width) * 4 + ended phrases."""
        langs = sorted(training)
        seen = sorted({b for texts in training.values() for t in texts for b in t})
        width = len(seen) + 1
        symbol = np.zeros(256, np.uint8)
        symbol[seen] = np.arange(1, width)
        parts, roots, sizes, base = [], [], [], 0
        for lang in langs:
            # A byte that is in no training text parts them.
            nexts = automaton(b"\xff".join(training[lang]))
            table = np.zeros((len(nexts), width), np.int32)
            known = np.zeros((len(nexts), width), bool)
            for state, out in enumerate(nexts):
                for c, to in out.items():
                    if c != 255:
                        table[state, symbol[c]], known[state, symbol[c]] = to, True
            # Where a phrase cannot go on it ends, and the byte starts the next one; a byte that no
            # phrase can hold is one by itself.
            restart, lone = table[0].copy(), ~known[0]
            ended = np.where(known, 0, 1 + lone[None, :]).astype(np.uint8)
            ended[0] = lone
            np.copyto(table, restart[None, :], where=~known)
            table += base
            table *= width * 4
            table += ended
            parts.append(table.reshape(-1))
            roots.append(base * width)
            sizes.append(max(2, sum(map(len, training[lang]))))
            base += len(nexts)
        return langs, sizes, symbol, np.concatenate(parts), np.array(roots, np.int32)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (rows) against each language (columns)."""
        n_langs = len(self.langs)
        size = np.array([len(t) for t in texts], np.int64)
        blocks = -(-size // BLOCK)
        count = np.zeros((len(texts), n_langs), np.int64)
        total = int(blocks.sum())
        if not total:
            return count
        owner = np.repeat(np.arange(len(texts)), blocks)
        number = np.arange(total) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = np.repeat(np.cumsum(size) - size, blocks) + number * BLOCK
        length = np.minimum(BLOCK, np.repeat(size, blocks) - number * BLOCK)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        flat = self.symbol[np.frombuffer(b"".join(texts), np.uint8)].astype(np.int32)
        # Number of blocks that still have a byte at each step.
        active = total - np.searchsorted(np.sort(length), np.arange(BLOCK), "right")
        for k in range(n_langs):
            state = np.full(total, self.roots[k], np.int32)
            ended = np.zeros(total, np.int32)
            root = self.roots[k]
            for step in range(int(length[0])):
                n = int(active[step])
                at = self.steps[state[:n] + flat[begin[:n] + step]]
                ended[:n] += at & 3
                state[:n] = at >> 2
            ended += state != root
            count[:, k] = np.bincount(owner, weights=ended, minlength=len(texts))
        return count

    def judge(self, texts: list[str | None]) -> list[dict]:
        """Language and score; ``und`` and 0 for a text without a letter."""
        clean = [letters(t) for t in texts]
        out: list[dict] = []
        at = 0
        while at < len(clean):
            upto, held = at, 0
            while upto < len(clean) and (upto == at or held + len(clean[upto]) <= _SLICE_BYTES):
                held += len(clean[upto])
                upto += 1
            out += self._judge(texts[at:upto], clean[at:upto])
            at = upto
        return out

    def _judge(self, texts, clean) -> list[dict]:
        if not self.langs:
            return [{"lang": "und", "score": 0.0}] * len(texts)
        found = self.phrases(clean)
        size = np.maximum(1, np.array([len(t) for t in clean]))
        # Phrases times the bits that name one, over the bytes parsed.
        bits = found * np.log2(np.array(self.sizes, float)) / size[:, None]
        likely = np.exp2(-(bits - bits.min(axis=1, keepdims=True)))
        best = bits.argmin(axis=1)
        score = 1 / likely.sum(axis=1)
        return [
            {"lang": self.langs[b], "score": float(s)}
            if has_letter(text)
            else {"lang": "und", "score": 0.0}
            for text, b, s in zip(texts, best.tolist(), score.tolist())
        ]


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows: int = ROWS_PER_LANGUAGE,
    most_bytes: int = LANGUAGE_BYTES,
    text_bytes: int = TEXT_BYTES,
) -> Sample:
    """Training texts of each language, from at most ``rows`` labelled texts of it.

    The rows with the smallest text hash are taken, repeated texts once; a language that holds most
    rows is ranked in salted groups first. Each language has ``most_bytes`` of letters, of which one
    text gives ``text_bytes`` at most, in a second turn more if there are too few texts. Rows
    without a language or a letter are not used.
    """
    rows_of = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    hashed = rows_of.select("lang", F.xxhash64("text").alias("h")).distinct()
    salted = hashed.withColumn("salt", F.pmod("h", F.lit(_SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        n = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
        salted = salted.withColumn("n", n).where(f"n <= {rows}").drop("n")
    chosen = salted.drop("salt")
    picked = rows_of.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
    # No more of a text is needed than a language may have.
    sample = picked.select("lang", "h", F.substring("text", 1, most_bytes).alias("text"))
    found = {(r["lang"], r["h"]): r["text"] for r in sample.toLocalIterator()}
    by_lang: dict[str, list[bytes]] = {}
    room: dict[str, int] = {}
    bodies = {key: letters(body) for key, body in sorted(found.items())}
    for first, last in ((0, text_bytes), (text_bytes, most_bytes)):
        for (name, _), body in bodies.items():
            left = room.setdefault(name, most_bytes)
            part = body[first : min(last, first + left)]
            room[name] = left - len(part)
            if part:
                by_lang.setdefault(name, []).append(part)
    return tuple((name, tuple(parts)) for name, parts in by_lang.items())


@functools.lru_cache(maxsize=1)
def _parser(model: Sample) -> Parser:
    """Tables of the sample, worked out once in each Python worker.

    They are some hundred times the sample, so the driver neither makes nor sends them.
    """
    return Parser(*Parser.tables({name: list(parts) for name, parts in model}) if model else ([], [], None, None, None))


def identify(docs: DataFrame, model: Sample, into: str = "_lang", text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``into``: lang and score (0 to 1).

    The score is the winner's share of 2 to the minus bits a byte over all languages. A null text,
    one without a letter, and every text if nothing was learnt, is ``und`` with score 0. Equal
    phrases: the first language in order. Every row gives one row. A column ``into`` is refused.
    """
    refuse_taken(docs, into)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = arrow_type(StructType.fromDDL(RESULT))

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = _parser(shared.value)
        for texts in batches:
            yield pa.array(parser.judge(texts.to_pylist()), type=schema)

    return docs.withColumn(into, F.arrow_udf(rows, RESULT).asNondeterministic()(F.col(text)))
