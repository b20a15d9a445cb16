"""Language identification: words first, then ever shorter character n-grams.

A word that was learned in any language scores by its smoothed log frequency in each.  An unseen word
falls back to its character n-grams of the greatest length of which any was learned, down to single
letters; their mean log frequency counts as one word.  The language with the greatest sum wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import is_remainder

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_WORD = re.compile(r"[^\W\d_]+")
_LONGEST = 5
_AT_ONCE = 10_000


def _grams(word: str, length: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


@dataclass(frozen=True)
class Model:
    """Rows of log frequencies by language, and the row of each word (at 0) and n-gram (at its length)."""

    languages: tuple[str, ...]
    rows: tuple[dict[str, int], ...]
    table: np.ndarray

    def word(self, word: str) -> list[int]:
        """The rows whose mean is the word's score; none if not even a letter was learned."""
        known = self.rows[0].get(word)
        if known is not None:
            return [known]
        for length in range(min(_LONGEST, len(word) + 2), 0, -1):
            learned = self.rows[length]
            found = [learned[gram] for gram in _grams(word, length) if gram in learned]
            if found:
                return found
        return []

    def forms(self, forms: list[str]) -> np.ndarray:
        """Scores of forms: strings without white space, of which the runs of letters are words.

        The last two columns count a form's words, and those of them that were learned as a whole.
        """
        rows, weights, owners = [], [], []
        out = np.zeros((len(forms), len(self.languages) + 2))
        for owner, form in enumerate(forms):
            for word in _WORD.findall(form):
                out[owner, -2] += 1
                out[owner, -1] += word in self.rows[0]
                found = self.word(word)
                rows += found
                weights += [1 / len(found)] * len(found) if found else []
                owners += [owner] * len(found)
        values = self.table[rows] * np.array(weights)[:, None]
        for language in range(len(self.languages)):
            out[:, language] = np.bincount(owners, weights=values[:, language], minlength=len(forms))
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams by language, flushed whenever many have gathered."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        lang, kind, gram, n = [], [], [], []
        for language, words in counts.items():
            grams: dict[int, Counter] = {length: Counter() for length in range(1, _LONGEST + 1)}
            for word, times in words.items():
                for length, counter in grams.items():
                    for part in _grams(word, length):
                        counter[part] += times
            for k, counter in [(0, words), *grams.items()]:
                lang += [language] * len(counter)
                kind += [k] * len(counter)
                gram += counter.keys()
                n += counter.values()
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(kind, pa.int32()), pa.array(gram, pa.string()), pa.array(n, pa.int64())],
            names=["lang", "kind", "gram", "n"],
        )

    counts: dict[str, Counter] = {}
    for batch in batches:
        for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.setdefault(language, Counter()).update(_WORD.findall(text.lower()))
        if sum(map(len, counts.values())) > 100_000:
            yield rows(counts)
            counts = {}
    yield rows(counts)


def train(
    labelled: DataFrame, rows_per_language: int = 4_000, grams_per_kind: int = 20_000, max_languages: int = 256
) -> Model:
    """Learn from ``text`` and ``lang`` of rows whose text and lang are not null.

    Bounds: about ``rows_per_language`` rows of each language, picked by a hash of number and text; the
    ``max_languages`` most frequent labels; the ``grams_per_kind`` most frequent words, and n-grams of
    each length, of each language.  No rows: a model of no language, which answers ``und``.
    """
    usable = labelled.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    top = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    share = F.lit(0.0)
    for row in top:
        share = F.when(F.col("lang") == row["lang"], min(1.0, rows_per_language / row["count"])).otherwise(share)
    picked = usable.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share * 1_000_000)
    counts = (
        picked.select("lang", "text")
        .mapInArrow(_count, "lang string, kind int, gram string, n long")
        .groupBy("lang", "kind", "gram")
        .agg(F.sum("n").alias("n"))
    )
    place = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "gram"))
    kept = counts.withColumn("place", place).filter(F.col("place") <= grams_per_kind).drop("place").toPandas()

    languages = tuple(sorted(row["lang"] for row in top))
    number = {language: i for i, language in enumerate(languages)}
    rows: list[dict[str, int]] = [{} for _ in range(_LONGEST + 1)]
    tables, size = [np.zeros((0, len(languages)))], 0
    for kind, part in kept.groupby("kind"):
        codes, grams = part["gram"].factorize()
        table = np.zeros((len(grams), len(languages)))
        table[codes, part["lang"].map(number)] = part["n"]
        tables.append(np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * (len(grams) + 1))))
        rows[int(kind)] = {gram: size + i for i, gram in enumerate(grams)}
        size += len(grams)
    return Model(languages, tuple(rows), np.concatenate(tables))


def predict(docs: DataFrame, model: Model, kept: int = 150_000) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``known``; only ``text`` is looked at.

    ``und`` and zeros for texts that are null or have no letter, and if no language was learned.  The score
    is the probability of the language among those learned given a word of the text's mean log
    frequencies, so that it does not grow with the text; ties go to the language that sorts first.
    ``known`` is the share of the text's words that were learned as a whole, in any language.  Scores of
    ``kept`` word forms at most are remembered.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = broadcast.value
        places: dict[str, int] = {}
        table = np.zeros((kept + _AT_ONCE, len(learned.languages) + 2))

        def scored(forms: list[str]) -> np.ndarray:
            if len(places) > kept:
                places.clear()
            new = list(set(forms).difference(places))
            table[len(places) : len(places) + len(new)] = learned.forms(new)
            places.update(zip(new, range(len(places), len(places) + len(new))))
            return table[np.fromiter(map(places.__getitem__, forms), np.int64, len(forms))].sum(axis=0)

        def predicted(text: str | None) -> tuple[str, float, float]:
            if not text or not learned.languages or not _LETTER.search(text):
                return UNDETERMINED, 0.0, 0.0
            forms = text.lower().split()
            total = sum(scored(forms[begin : begin + _AT_ONCE]) for begin in range(0, len(forms), _AT_ONCE))
            # Letters that are marks or numerals only in lower case leave no word.
            words = max(total[-2], 1.0)
            best = int(total[:-2].argmax())
            odds = np.exp((total[:-2] - total[best]) / words)
            return learned.languages[best], float(1 / odds.sum()), float(total[-1] / words)

        for batch in batches:
            found = [predicted(text) for text in batch.column("text").to_pylist()]
            langs, scores, shares = zip(*found) if found else ((), (), ())
            batch = batch.append_column("lang_pred", pa.array(langs, pa.string()))
            batch = batch.append_column("score", pa.array(scores, pa.float64()))
            yield batch.append_column("known", pa.array(shares, pa.float64()))

    fields = [f"`{field.name}` {field.dataType.simpleString()}" for field in docs.schema]
    return docs.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double", "known double"]))


def identify(docs: DataFrame, modulus: int = 3, held_out: int = 1, **bounds) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of all rows, learned from those that are not held out.

    A row is held out if crc32 of its number as text leaves the remainder; null numbers are not.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], docs["lang"])
    rows = rows.withColumn("held_out", is_remainder("doc_id", modulus, held_out))
    model = train(rows.filter(~F.col("held_out")), **bounds)
    return predict(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
