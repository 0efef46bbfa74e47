"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. A trigram binds the vectors of its
letters, the first rotated by two places and the second by one, by multiplication. A document bundles its
trigrams by addition, a language bundles its documents, and a document has the language whose prototype is
nearest by cosine. Everything but the prototypes, one vector per language, stays in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import bounded_sample_per_class, crc_of_id, table

DIMENSIONS = 1024
SEED = 7
#: Labelled documents the prototypes are bundled from, at most.
TRAIN_ROWS = 20_000
#: Of a language with fewer than that many in the sample, about that many are drawn beside it, or all there are.
LEAST_ROWS = 200
UNKNOWN = "und"
_SPACE = 32
#: Trigram vectors a task keeps, one byte per dimension; beyond it they are made anew.
_KEPT = 100_000


class _Encoder:
    """Vectors of letters and trigrams of one Python worker."""

    def __init__(self, dimensions: int, seed: int) -> None:
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.places: dict[int, int] = {}
        self.grams = np.empty((4096, dimensions), dtype=np.int8)
        self.is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > _KEPT:
                self.letters.clear()
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, dtype=np.int8)
            self.letters[code] = 2 * bits - 1
        return self.letters[code]

    def _rows(self, keys: list[int]) -> np.ndarray:
        if len(self.places) + len(keys) > _KEPT:
            self.places.clear()
        missing = [k for k in keys if k not in self.places]
        need = len(self.places) + len(missing)
        if need > len(self.grams):
            more = np.empty((max(need, 2 * len(self.grams)), self.dimensions), dtype=np.int8)
            more[: len(self.places)] = self.grams[: len(self.places)]
            self.grams = more
        for key in missing:
            place = self.places[key] = len(self.places)
            first, second, third = key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF
            bound = np.roll(self._letter(first), 2) * np.roll(self._letter(second), 1) * self._letter(third)
            self.grams[place] = bound
        return self.grams[[self.places[k] for k in keys]]

    def encode(self, text: str | None) -> np.ndarray | None:
        """The bundle of a text's trigrams, of length one; None where it has no letter."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        letter = self.is_letter[codes]
        if not letter.any():
            return None
        codes = np.concatenate(([_SPACE], np.where(letter, codes, _SPACE), [_SPACE]))
        codes = codes[(codes != _SPACE) | (np.roll(codes, 1) != _SPACE) | (np.arange(len(codes)) == 0)]
        keys, counts = np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)
        bundle = np.zeros(self.dimensions, dtype=np.float64)
        for start in range(0, len(keys), 4096):
            rows = self._rows(keys[start : start + 4096].tolist())
            bundle += counts[start : start + 4096].astype(np.float32) @ rows.astype(np.float32)
        length = np.linalg.norm(bundle)
        return bundle / length if length else bundle


_ENCODERS: dict[tuple[int, int], _Encoder] = {}


def _encoder(dimensions: int, seed: int) -> _Encoder:
    return _ENCODERS.setdefault((dimensions, seed), _ENCODERS.get((dimensions, seed)) or _Encoder(dimensions, seed))


def prototypes(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED
) -> dict[str, np.ndarray]:
    """The prototype of each language: the bundle of its documents, of length one."""

    def bundle(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = _encoder(dimensions, seed), {}
        for batch in rows:
            for lang, text in batch.itertuples(index=False, name=None):
                vector = encoder.encode(text)
                if vector is not None:
                    sums[lang] = sums.get(lang, 0) + vector
        yield pd.DataFrame({"lang": list(sums), "bundle": [v.tolist() for v in sums.values()]})

    known = labelled.where(F.col(lang_col).isNotNull()).select(lang_col, text_col).toDF("lang", "body")
    parts = known.mapInPandas(bundle, "lang string, bundle array<double>")
    cells = parts.select("lang", F.posexplode("bundle").alias("place", "value"))
    summed = cells.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for row in summed.collect():  # languages x dimensions
        found.setdefault(row["lang"], np.zeros(dimensions))[row["place"]] = row["value"]
    return {lang: v / (np.linalg.norm(v) or 1.0) for lang, v in sorted(found.items())}


def identify(
    docs: DataFrame,
    known: dict[str, np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row: the nearest prototype and its cosine, 0 where negative.

    A null text, and one without letters, is ``und`` with score 0, and so is all where no language is known. Of
    languages equally near the alphabetically first wins. Repeated rows and null ids stay. Other columns are not read.
    """
    names, matrix = list(known), np.array(list(known.values())).reshape(len(known), dimensions)

    @F.pandas_udf("lang string, score double")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        encoder, out = _encoder(dimensions, seed), []
        for text in texts:
            vector = encoder.encode(text) if names else None
            if vector is None:
                out.append((UNKNOWN, 0.0))
            else:
                cosines = matrix @ vector
                best = int(np.argmax(cosines))
                out.append((names[best], float(np.clip(cosines[best], 0.0, 1.0))))
        return pd.DataFrame(out, columns=["lang", "score"])

    found = docs.select(F.col(id_col).alias("doc_id"), nearest(F.col(text_col)).alias("p"))
    return found.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def held_out() -> Column:
    return F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(4)) == 2, F.lit(False))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    known = prototypes(bounded_sample_per_class(learn, "lang", F.col("doc_id"), TRAIN_ROWS, LEAST_ROWS))
    return identify(docs, known).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
