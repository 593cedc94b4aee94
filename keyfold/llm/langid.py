"""Language ID with one bit-sliced Bloom filter over character n-grams.

Each slot of the filter holds a bitmask with one bit per language; the AND of
an n-gram's slots is the set of languages that (may) contain it, so one lookup
asks all languages. A text's n-grams are counted per language, each count is
corrected by that language's measured false-positive rate, and the largest
corrected share decides.

Learning: per language about ``sample_per_lang`` labelled rows (those whose
hash of id and text lies in a share of the range set by the language's row
count; all, if there are fewer), a bound that does not depend on the input. An n-gram belongs to a language when at least ``min_share`` of its
sampled texts hold it; so a language has at most (n-grams per text) /
``min_share`` of them, which bounds what is collected and broadcast.
Prediction reads whole texts.

Cases: a null text, or one without a letter, is ``und`` with score 0; rows of
null language are not learned from; with nothing to learn from every text is
``und``; ties go to the smaller language name; repeated rows and null ids are
predicted row by row; an empty table gives an empty result; other columns pass
through, and one named like an added column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm.words import mix

UNKNOWN = "und"
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters; built once per Python worker."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def ngrams(texts: list[str], n: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each n-gram, index of its text, whether each text has a letter).

    Lower-cased; runs of other characters than letters count as one space.
    """
    joined = "\0".join(t.replace("\0", " ") for t in texts).lower() + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    end = points == 0
    letter = _letters()[points]
    text_of = np.cumsum(end) - end
    has_letter = np.bincount(text_of[letter], minlength=len(texts)) > 0
    points = np.where(letter | end, points, 32)
    space = points == 32
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    # one space at both ends of each text, so that word edges look alike everywhere
    marks = np.where(end, 32, points)[keep].astype(np.uint64)
    text_of = text_of[keep]
    if len(marks) < n:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), has_letter
    grams = np.zeros(len(marks) - n + 1, dtype=np.uint64)
    for i in range(n):
        grams = (grams << np.uint64(21)) | marks[i:len(marks) - n + 1 + i]
    inside = text_of[:len(grams)] == text_of[n - 1:]
    return mix(grams[inside]), text_of[:len(grams)][inside], has_letter


@dataclass
class LanguageFilter:
    """masks[word, slot]: 64 languages per word; rates: false positives per language."""

    names: list[str]
    masks: np.ndarray
    rates: np.ndarray
    hashes: int
    n: int

    @classmethod
    def build(cls, names: list[str], grams: np.ndarray, lang: np.ndarray, *, n: int = 3, hashes: int = 3,
              slots_per_gram: int = 24) -> LanguageFilter:
        size = 1 << max(10, int(np.ceil(np.log2(max(1, len(np.unique(grams))) * slots_per_gram))))
        masks = np.zeros((max(1, -(-len(names) // 64)), size), dtype=np.uint64)
        for k in range(hashes):
            np.bitwise_or.at(masks, (lang // 64, cls._slot(grams, k, size)), np.uint64(1) << (lang % 64).astype(np.uint64))
        fill = np.array([((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(names))])
        return cls(names, masks, fill ** hashes, hashes, n)

    @staticmethod
    def _slot(grams: np.ndarray, k: int, size: int) -> np.ndarray:
        return (mix(grams + np.uint64(k)) & np.uint64(size - 1)).astype(np.int64)

    def languages(self, grams: np.ndarray) -> np.ndarray:
        """The masks of all languages that hold each n-gram: [word, n-gram]."""
        found = self.masks[:, self._slot(grams, 0, self.masks.shape[1])]
        for k in range(1, self.hashes):
            found &= self.masks[:, self._slot(grams, k, self.masks.shape[1])]
        return found

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(corrected share of known n-grams [text, language], whether each text has a letter)."""
        grams, text_of, has_letter = ngrams(texts, self.n)
        found = self.languages(grams)
        total = np.bincount(text_of, minlength=len(texts))
        out = np.zeros((len(texts), len(self.names)))
        for i, rate in enumerate(self.rates):
            bit = (found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(text_of, weights=bit, minlength=len(texts))
            out[:, i] = (hits - total * rate) / np.maximum(total, 1) / max(1e-9, 1 - rate)
        return np.clip(out, 0, 1), has_letter

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        shares, has_letter = self.shares([t or "" for t in texts])
        best = shares.argmax(axis=1)  # the first of equals; names are sorted
        return ([self.names[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)],
                [float(shares[i, b]) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, has_letter))])


def train(docs: DataFrame, *, learn: Column, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
          n: int = 3, sample_per_lang: int = 4000, min_share: float = 0.02, max_languages: int = 1024) -> LanguageFilter:
    """Learn from rows where ``learn`` holds and text and language are not null."""
    known = docs.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
    bounds = known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("rows")).orderBy("lang").limit(max_languages + 1).collect()
    if len(bounds) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    names = [b.lang for b in bounds]
    if not names:
        return LanguageFilter.build([], np.empty(0, np.uint64), np.empty(0, np.int64), n=n)
    # a fixed share of the hash range holds about sample_per_lang rows of each language
    share = F.create_map(*[x for b in bounds for x in (F.lit(b.lang), F.lit(min(1.0, sample_per_lang / b.rows)))])
    index = F.create_map(*[x for i, b in enumerate(bounds) for x in (F.lit(b.lang), F.lit(i))])
    place = F.pmod(F.xxhash64(id_col, text), F.lit(1 << 30)) / (1 << 30)
    sample = known.where(place < share[F.col(lang)]).select(F.col(text).alias("text"), index[F.col(lang)].alias("lang"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            code = batch.column("lang").to_numpy(zero_copy_only=False).astype(np.uint64)
            texts = batch.column("text").to_pylist()
            for i in range(0, len(texts), 500):
                grams, text_of, _ = ngrams(texts[i:i + 500], n)
                pairs = np.unique(np.stack([grams, text_of.astype(np.uint64)]), axis=1) if len(grams) else np.zeros((2, 0), np.uint64)
                keys, df = np.unique(np.stack([pairs[0], code[i:i + 500][pairs[1].astype(np.int64)]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys[0].view(np.int64)), pa.array(keys[1].astype(np.int32)), pa.array(df)],
                                                 names=["gram", "lang", "df"])

    counts = sample.mapInArrow(count, "gram long, lang int, df long").groupBy("gram", "lang").agg(F.sum("df").alias("df"))
    least = F.create_map(*[x for i, b in enumerate(bounds) for x in (F.lit(i), F.lit(max(1.0, min_share * min(b.rows, sample_per_lang))))])
    table = counts.where(F.col("df") >= least[F.col("lang")]).select("gram", "lang").toArrow()
    grams = table.column("gram").to_numpy().view(np.uint64)
    return LanguageFilter.build(names, grams, table.column("lang").to_numpy().astype(np.int64), n=n)


def predict(docs: DataFrame, model: LanguageFilter, *, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``; the filter (bounded, see above) is broadcast."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def decide(texts):
        import pandas as pd

        names, scores, values = [], [], texts.tolist()
        for i in range(0, len(values), 200):
            a, b = shared.value.predict(values[i:i + 200])
            names += a
            scores += b
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn("_p", decide(text)).select(*[docs[c] for c in docs.columns], "_p.lang_pred", "_p.score")


