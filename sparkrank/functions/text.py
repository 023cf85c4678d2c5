"""Text analysis: tokenise, lower-case, stop words, stemming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrank.functions.porter2 import stem_word

# Approximation of Unicode word segmentation for Latin scripts.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"

# The 33 default English stop words of the analyser.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()


def tokens(text: Column) -> Column:
    """Lower-cased tokens in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def without_stop_words(toks: Column, stop: list[str] | None = None) -> Column:
    words = STOP_WORDS if stop is None else stop
    return F.filter(toks, lambda t: ~t.isin(words)) if words else toks


CACHED_STEMS = 500_000


def _stem_all(words: pd.Series, known: dict[str, str]) -> np.ndarray:
    """Stem each distinct word once; ``known`` carries over to the next batch of the task."""
    codes, distinct = pd.factorize(words)
    if len(known) > CACHED_STEMS:
        known.clear()
    for word in distinct:
        if word not in known:
            known[word] = stem_word(word)
    return np.array([known[w] for w in distinct], dtype=object)[codes]


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Stem arrays of tokens. No shuffle of a vocabulary, so a frequent word is no hot key."""
    known: dict[str, str] = {}
    for toks in batches:
        sizes = toks.map(len).to_numpy()
        if sizes.sum() == 0:
            yield toks
            continue
        flat = pd.Series(np.concatenate([np.asarray(t, dtype=object) for t in toks]))
        yield pd.Series(np.split(_stem_all(flat, known), np.cumsum(sizes)[:-1]))


@F.pandas_udf(T.StringType())
def stem_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Stem a column of single tokens (a vocabulary)."""
    known: dict[str, str] = {}
    for words in batches:
        yield pd.Series(_stem_all(words, known))


def analyze(text: Column, stem: bool = True, stop: list[str] | None = None) -> Column:
    """The whole analyser chain as one array<string> column."""
    kept = without_stop_words(tokens(F.coalesce(text, F.lit(""))), stop)
    return stem_tokens(kept) if stem else kept


def title_case(text: Column) -> Column:
    """Capital after every non-letter: ``t-shirt`` gives ``T-Shirt``."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")
