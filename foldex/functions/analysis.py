"""Text analysis as plain columns: lower-cased word tokens, optional stop words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a maximal run of letters and digits.
WORD_PATTERN = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class Analyzer:
    """Splits text into tokens; ``by_field`` overrides the analyser of single fields."""

    stop_words: Sequence[str] = ()
    lower: bool = True
    pattern: str = WORD_PATTERN
    by_field: Mapping[str, Analyzer] = field(default_factory=dict)

    def for_field(self, name: str) -> Analyzer:
        return self.by_field.get(name, self)

    def tokens(self, text: Column) -> Column:
        """Token array of one text column, duplicates and order kept; null text gives null."""
        source = F.lower(text) if self.lower else text
        words = F.regexp_extract_all(source, F.lit(self.pattern), F.lit(0))
        if not self.stop_words:
            return words
        stop = list(self.stop_words)
        return F.filter(words, lambda w: ~w.isin(stop))


STANDARD = Analyzer()


def stop_words(language: str) -> list[str]:
    """Spark ML's stop word list of a language, for example ``german``."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords(language)
