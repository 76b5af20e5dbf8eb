"""Text normalisation."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folding() -> Callable[[str | None], str]:
    # Built inside a function, so it travels to the Python workers by value and they need not
    # have this package installed.
    def fold(value: str | None) -> str:
        decomposed = unicodedata.normalize("NFKD", value or "")
        return " ".join(decomposed.encode("ascii", "ignore").decode("ascii").lower().split())

    return fold


fold_text = _folding()


def _plain_letters() -> tuple[str, str]:
    """Letters of the Latin blocks that fold to one ASCII character, and these characters."""
    folded = {chr(code): fold_text(chr(code)) for code in range(0xC0, 0x250)}
    single = {letter: plain for letter, plain in folded.items() if len(plain) == 1}
    return "".join(single), "".join(single.values())


_LETTERS = _plain_letters()
_ASCII = "\\A[\\x00-\\x7F]*\\z"
#: White space as Python has it, among ASCII.
_SPACE_RUN = "[\\t-\\r\\x1C-\\x20]+"


def fold_label(text: Column | str) -> Column:
    """Lower-case ASCII form with single spaces; null becomes the empty label.

    ASCII and the accented letters of the Latin blocks are folded by built-in functions. Only texts
    with other characters, whose compatibility decomposition has no built-in counterpart, go to
    Python, in Arrow batches; repeats inside one batch are folded once.
    """
    fold, text = fold_text, F.col(text) if isinstance(text, str) else text

    def fold_batch(labels: pd.Series) -> pd.Series:
        folded = {value: fold(value) for value in labels.dropna().unique()}
        return pd.Series([folded.get(value) for value in labels], dtype=object)

    fold_batch.__annotations__ = {"labels": pd.Series, "return": pd.Series}
    plain = F.translate(text, *_LETTERS)
    known = plain.rlike(_ASCII)
    others = F.pandas_udf(fold_batch, T.StringType())(F.when(~known, text))
    spaced = F.regexp_replace(F.lower(plain), _SPACE_RUN, " ")
    return F.coalesce(F.when(known, F.btrim(spaced)), others, F.lit(""))


def filled(text: Column) -> Column:
    """Null for the empty text, so that coalesce skips it."""
    return F.nullif(text, F.lit(""))
