"""Models behind a batch call: loaded once per Python worker, errors as values.

``factory()`` loads a model on the worker and returns ``predict(list[str]) -> list[str]``.
A batch that fails is retried text by text, so one bad text costs one error value and not
its neighbours' results.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql import types as T

Predict = Callable[[list], list]

RESULT = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("error", T.StringType())]
)


def _one_by_one(predict: Predict, texts: list) -> tuple[list, list]:
    values, errors = [], []
    for text in texts:
        try:
            values.append(predict([text])[0])
            errors.append(None)
        except Exception as problem:
            values.append(None)
            errors.append(str(problem))
    return values, errors


def model_column(factory: Callable[[], Predict], batch_size: int = 32) -> Callable[[Column], Column]:
    """A function from a text column to ``struct<value, error>``."""

    def make_predict():
        predict = factory()

        def on_batch(texts: np.ndarray) -> dict[str, np.ndarray]:
            batch = list(texts)
            try:
                values, errors = list(predict(batch)), [None] * len(batch)
                if len(values) != len(batch):
                    raise ValueError("one result per text expected")
            except Exception:
                values, errors = _one_by_one(predict, batch)
            return {
                "value": np.array(values, dtype=object),
                "error": np.array(errors, dtype=object),
            }

        return on_batch

    return predict_batch_udf(make_predict, return_type=RESULT, batch_size=batch_size)
