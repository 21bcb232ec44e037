"""Sentiment labels: by a word list in the plan, or by a model."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

from newsflow.functions.text import WORD_GAP, error_text, let, normalise_label, strip, truncate
from newsflow.schemas import SENTIMENT_CHARS, UNKNOWN_LABEL


def lexicon_label(
    text: Column, weights: Mapping[str, float], chars: int | None = None
) -> Column:
    """Sign of the summed word weights over the text, or its first ``chars`` characters.

    The words stand in the plan as one hash set per weight, so the text is neither
    exploded nor joined.
    """
    by_weight: dict[float, list[str]] = {}
    for word, weight in weights.items():
        by_weight.setdefault(float(weight), []).append(word.lower())

    def label(head: Column) -> Column:
        def scored(words: Column) -> Column:
            total = F.lit(0.0)
            for weight, group in sorted(by_weight.items()):
                hits = F.size(F.filter(words, lambda w: w.isin(sorted(group))))
                total = total + hits * F.lit(weight)
            return total

        total = let(F.split(F.lower(head), WORD_GAP), scored)
        return F.when(head == "", UNKNOWN_LABEL).otherwise(
            let(
                total,
                lambda t: F.when(t > 0, "positive").when(t < 0, "negative").otherwise("neutral"),
            )
        )

    return let(strip(text) if chars is None else truncate(strip(text), chars), label)


def model_label(
    text: Column, model: Callable[[Column], Column], chars: int = SENTIMENT_CHARS
) -> Column:
    """Label of the first ``chars`` characters by a model column; blank text is unknown.

    Only the part the model sees is sent to Python.
    """
    head = truncate(strip(text), chars)
    result = model(head)
    label = F.coalesce(normalise_label(result["value"]), F.lit(UNKNOWN_LABEL))
    return (
        F.when(head == "", UNKNOWN_LABEL)
        .when(result["error"].isNotNull(), error_text(result["error"]))
        .otherwise(label)
    )
