"""Language identification by rank-order profiles.

A profile lists the most frequent letter 1- to 3-grams in order. A document's profile
is compared to each language's by the out-of-place distance: for each of its n-grams the
difference of the two ranks, or the profile length where the language lacks the n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.llm.common import map_texts, portions

#: N-grams of a profile.
PROFILE = 300
#: Characters counted together in a task; a bound of memory, results don't depend on it.
GROUP = 400_000
#: n-gram codes hold three symbols of 21 bits: 0 none, 1 word edge, else code point + 2.
SYMBOL = 21
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram code, count) of all texts, in order of number and code.

    N-grams don't cross words: words are maximal runs of letters of the lower-cased text,
    each with an edge symbol before and after it.
    """
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter((len(t) + 1 for t in lowered), np.int64, len(lowered))
    x = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    doc = np.concatenate([np.zeros(1, np.int64), np.repeat(np.arange(len(texts)), sizes)])
    is_letter = letters()[x]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[0] = True
    x, doc, is_letter = x[keep], doc[keep], is_letter[keep]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols = np.unique(x[is_letter])
    bits = int(len(symbols) + 2).bit_length()
    if 3 * bits + len(texts).bit_length() > 62:
        if len(texts) > 1:
            half = len(texts) // 2
            a, b = gram_counts(texts[:half]), gram_counts(texts[half:])
            return np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
        bits = SYMBOL
    s = np.where(is_letter, np.searchsorted(symbols, x) + 2, 1).astype(np.int64)
    m = is_letter
    two = m[:-1] | m[1:]
    three = m[1:-1]
    keys = np.concatenate([
        (doc[m] << (3 * bits)) | s[m],
        (np.where(m[:-1], doc[:-1], doc[1:])[two] << (3 * bits)) | (s[:-1][two] << bits) | s[1:][two],
        (doc[1:-1][three] << (3 * bits)) | (s[:-2][three] << (2 * bits)) | (s[1:-1][three] << bits) | s[2:][three],
    ])
    keys.sort()
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(starts, len(keys)))
    keys = keys[starts]
    back = np.concatenate([[0, 1], symbols.astype(np.int64) + 2])
    low = (1 << bits) - 1
    code = (back[(keys >> (2 * bits)) & low] << (2 * SYMBOL)) | (back[(keys >> bits) & low] << SYMBOL) | back[keys & low]
    return keys >> (3 * bits), code, counts


def top_ranked(doc: np.ndarray, code: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, code, rank) of each text's most frequent n-grams; ties go by code."""
    order = np.argsort((doc << 32) - np.minimum(count, (1 << 32) - 1), kind="stable")
    doc, code = doc[order], code[order]
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.append(first, len(doc))))
    keep = rank < size
    return doc[keep], code[keep], rank[keep]


def groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about GROUP characters, with the number of the first."""
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= GROUP:
            yield start, texts[start : i + 1]
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def _summed(parts: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(parts).groupby(["lang", "gram"], sort=False, as_index=False)["n"].sum()


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """The profile of each language: its `size` most frequent n-gram codes over all rows of df.

    Counts cover every row; rows whose text or language is null count for nothing. Each task
    adds up its own rows before the shuffle. The driver gets `size` codes a language.
    """

    kinds = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pd.DataFrame] = []
        for b in portions(batches):
            texts, langs = b.column(0).to_pylist(), np.asarray(b.column(1).to_pylist(), object)
            for at, group in groups(texts):
                doc, code, n = gram_counts(group)
                parts.append(_summed([pd.DataFrame({"lang": langs[at + doc], "gram": code, "n": n})]))
                if len(parts) > 8:
                    parts = [_summed(parts)]
                if len(parts[0]) > 500_000:
                    yield pa.RecordBatch.from_pandas(parts.pop(0), kinds, preserve_index=False)
        if parts:
            yield pa.RecordBatch.from_pandas(_summed(parts), kinds, preserve_index=False)

    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    total = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = total.withColumn("place", place).where(F.col("place") <= size).select("lang", "place", "gram").collect()
    out: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r.lang, r.place)):
        out.setdefault(r.lang, []).append(r.gram)
    return out


def predict(df: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE, keep: list[str] | None = None, within: str | None = None) -> DataFrame:
    """(id, lang_pred, score) of every row, one narrow pass over the whole texts.

    The language with the smallest out-of-place distance wins, ties by name; the score is
    one less the distance over the largest possible. A text that is null, empty or without
    a letter is 'und' with score 0, as is every text if there are no profiles. Repeated rows
    get the same answer; other columns are ignored.
    """
    names = sorted(profiles)
    grams = np.unique(np.asarray([g for p in profiles.values() for g in p], np.int64))
    ranks = np.full((len(grams) + 1, len(names)), 2 * size, np.int64)  # a language without the n-gram: out of place by `size` at any rank
    for k, n in enumerate(names):
        ranks[np.searchsorted(grams, np.asarray(profiles[n], np.int64)), k] = np.arange(len(profiles[n]))

    def judge(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        doc, code, rank = top_ranked(*gram_counts(texts), size)
        if len(doc) and names:
            at = np.minimum(np.searchsorted(grams, code), len(grams) - 1)
            far = np.where((grams[at] == code)[:, None], np.abs(ranks[at] - rank[:, None]), size)
            far = np.minimum(far, size)
            first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            total, n = np.add.reduceat(far, first, axis=0), np.diff(np.append(first, len(doc)))
            own = doc[first]
            best[own] = total.argmin(axis=1)
            score[own] = 1 - total.min(axis=1) / (n * size)
        return best, score

    def make(texts: list[str]) -> tuple[None, list]:
        found = [judge(g) for _, g in groups(texts)]
        best = [names[i] if i >= 0 else UNKNOWN for f in found for i in f[0]]
        return None, [best, np.concatenate([f[1] for f in found]) if found else []]

    return map_texts(df, keep or [id_col], text_col, {"lang_pred": "string", "score": "double"}, make, within)


def identified(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, training: Column | None = None) -> DataFrame:
    """The rows of df whose language can be told; those predicted 'und' go.

    Profiles are learned from df's own labelled rows (those where `training` holds). The
    columns of df are kept as they are, whatever their names; rows are neither changed nor
    merged. Without any labelled row nothing can be told and nothing is kept.
    """
    profiles = learn(df if training is None else df.where(training), text_col, lang_col, size)
    whole = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))
    return predict(whole, profiles, text_col=text_col, keep=["row"], size=size, within="row").where(F.col("lang_pred") != UNKNOWN).select("row.*")
