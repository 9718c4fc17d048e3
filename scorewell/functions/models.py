"""Model wrappers: a model is a named function from ordered features to a double.

Two forms share one contract (result DOUBLE, NaN -> NULL, NULL in -> NULL out):

* ``LinearModel`` - a closed-form linear / logistic model compiled to a
  native Spark expression.  No Python worker, whole-stage codegen.
* ``PythonModel`` - any Python callable over a pandas batch, run as an
  iterator ``pandas_udf`` so the model is loaded once per task and rows
  cross the JVM/Python boundary in Arrow batches.

Features bind by *name*; a missing feature is an error naming it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from scorewell.contracts import FEATURE_METADATA, check_identifier
from scorewell.functions.columns import nan_to_null

try:  # Ship this module's helpers to Python workers by value: executors need
    # not have scorewell installed to run a model UDF built here.
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the API
    pass

LINKS = ("identity", "logistic")

def libm_exp(x: np.ndarray) -> np.ndarray:
    """Element-wise C-library ``exp`` over a float64 batch.

    Arrow's compute kernel applies the C library's ``exp`` to the whole
    batch in native code (no Python call per element); overflow gives
    ``inf``, NaN stays NaN.  The C library's result is what SQL engines
    return; numpy's ``exp`` may take a SIMD path, depending on the CPU,
    that can differ from it in the last bit.
    """
    x = np.asarray(x, dtype="float64")
    out = pc.exp(pa.array(x.ravel())).to_numpy(zero_copy_only=False)
    return out.reshape(x.shape)


def feature_columns(df: DataFrame, exclude: Sequence[str] = FEATURE_METADATA) -> list[str]:
    """All columns but the metadata ones, in file order (exact names)."""
    drop = set(exclude)
    return [c for c in df.columns if c not in drop]


def require_features(df: DataFrame, features: Sequence[str], model_name: str) -> None:
    have = set(df.columns)
    missing = [f for f in features if f not in have]
    if missing:
        raise ValueError(f"model {model_name!r}: feature column(s) missing: {missing}")


@dataclass(frozen=True)
class LinearModel:
    """``link(bias + sum_i w_i * x_i)`` with the terms added in the given order."""

    name: str
    weights: tuple[tuple[str, float], ...]
    bias: float = 0.0
    link: str = "identity"

    def __post_init__(self):
        check_identifier(self.name, "model name")
        if self.link not in LINKS:
            raise ValueError(f"unknown link {self.link!r}; expected one of {LINKS}")
        object.__setattr__(self, "weights", tuple((str(k), float(w)) for k, w in self.weights))

    @classmethod
    def of(cls, name: str, weights: dict[str, float], bias: float = 0.0, link: str = "identity"):
        return cls(name, tuple(weights.items()), bias, link)

    @property
    def features(self) -> list[str]:
        return [k for k, _ in self.weights]

    def column(self, df: DataFrame) -> Column:
        require_features(df, self.features, self.name)
        terms = [F.col(k).cast("double") * F.lit(w) for k, w in self.weights]
        z = terms[0]
        for t in terms[1:]:
            z = z + t
        if self.bias:
            z = F.lit(self.bias) + z
        if self.link == "logistic":
            z = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return nan_to_null(z)

    def as_python(self) -> "PythonModel":
        """This model run through the pandas-UDF path (same results)."""
        return PythonModel(
            self.name,
            _linear_predictor(self.weights, self.bias, self.link),
            features=tuple(self.features),
        )


def _linear_predictor(weights, bias, link) -> Callable[[pd.DataFrame], np.ndarray]:
    # A closure over plain data so it pickles by value to Python workers.
    pairs = tuple(weights)
    exp = libm_exp

    def predict(pdf: pd.DataFrame) -> np.ndarray:
        z = pdf[pairs[0][0]].to_numpy(dtype="float64") * pairs[0][1]
        for k, w in pairs[1:]:
            z = z + pdf[k].to_numpy(dtype="float64") * w
        if bias:
            z = bias + z
        if link == "logistic":
            z = 1.0 / (1.0 + exp(-z))
        return z

    return predict


@dataclass(frozen=True)
class PythonModel:
    """A Python model scored with an iterator pandas UDF.

    ``predict(pdf)`` - or ``predict(model, pdf)`` when ``loader`` is given -
    returns one double per row of the batch.  ``loader()`` runs once per
    task (e.g. deserialise weights), not once per batch.  ``features=None``
    means every non-metadata column, in order.
    """

    name: str
    predict: Callable[..., Any]
    features: tuple[str, ...] | None = None
    loader: Callable[[], Any] | None = field(default=None)

    def __post_init__(self):
        check_identifier(self.name, "model name")

    def column(self, df: DataFrame) -> Column:
        names = list(self.features) if self.features is not None else feature_columns(df)
        if not names:
            raise ValueError(f"model {self.name!r}: no feature columns")
        require_features(df, names, self.name)
        udf = _make_udf(names, self.predict, self.loader)
        # DECIMAL becomes DOUBLE before crossing to Python; everything else,
        # strings included, reaches the model as it is.
        kinds = {f.name: f.dataType for f in df.schema.fields}
        inputs = [
            F.col(c).cast("double") if isinstance(kinds[c], T.DecimalType) else F.col(c) for c in names
        ]
        return nan_to_null(udf(*inputs))


def _make_udf(names, predict, loader):
    names = list(names)

    @pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = loader() if loader is not None else None
        for cols in batches:
            if isinstance(cols, pd.Series):
                cols = (cols,)
            pdf = pd.DataFrame({n: c for n, c in zip(names, cols)})
            out = predict(model, pdf) if loader is not None else predict(pdf)
            yield pd.Series(np.asarray(out, dtype="float64"))

    return score
