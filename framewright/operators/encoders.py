"""Contract of model operators: batches of values in, vectors or structs out, over Arrow.

A model is a name, an output length and a loader; the loader runs once in each Python worker and gives a
function from a list of inputs to an array. No model weights come with this library: `stub` stands in for
any of them with vectors made from the input's bytes, and is not a model's output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encode = Callable[[list], np.ndarray]


@dataclass(frozen=True)
class Model:
    name: str
    dim: int
    takes: str  # image, text or audio
    load: Callable[[], Encode] | None = None
    batch: int = 128


# What model slots take, and the length of their vectors.
SLOTS = {m.name: m for m in (Model("siglip", 1152, "image"), Model("siglip2", 1152, "image"), Model("pe", 1024, "image"), Model("dinov3", 1024, "image"), Model("gte", 768, "text", batch=64))}
_loaded: dict[str, Encode] = {}


def stub(name: str, dim: int) -> Encode:
    """Deterministic unit vectors from the input's bytes, for tests and dry runs."""

    def encode(values: list) -> np.ndarray:
        out = np.empty((len(values), dim), np.float32)
        for k, v in enumerate(values):
            raw = v.encode() if isinstance(v, str) else bytes(v or b"")
            seed = int.from_bytes(hashlib.blake2b(name.encode() + raw, digest_size=8).digest(), "little")
            x = np.random.default_rng(seed).standard_normal(dim)
            out[k] = x / np.linalg.norm(x)
        return out

    return encode


def encode(df: DataFrame, column: str, model: Model, into: str = "vec", half: bool = True) -> DataFrame:
    """df with array<float> `into` and string `error`: unit vectors of column, rounded to half precision.

    A failing batch is tried value by value; a value that fails has a null vector and its error.
    """
    name, dim, size, load = model.name, model.dim, model.batch, model.load

    def run(batches):
        if name not in _loaded:
            _loaded[name] = load() if load else stub(name, dim)
        f = _loaded[name]
        at = None
        for b in batches:
            at = b.schema.get_field_index(column)
            for i in range(0, b.num_rows, size):
                some = b.slice(i, size)
                values = some.column(at).to_pylist()
                vec, error = [None] * len(values), [None] * len(values)
                try:
                    vec = list(f(values))
                except Exception:  # noqa: BLE001  one bad value must not lose the rest
                    for k, v in enumerate(values):
                        try:
                            vec[k] = f([v])[0]
                        except Exception as e:  # noqa: BLE001
                            error[k] = f"{type(e).__name__}: {e}"
                vec = [None if v is None else (v.astype(np.float16).astype(np.float32) if half else v.astype(np.float32)) for v in vec]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(vec, pa.list_(pa.float32())), pa.array(error, pa.string())], [*some.schema.names, into, "error"])

    from pyspark.sql.types import ArrayType, FloatType, StringType, StructType

    schema = StructType([*df.schema.fields]).add(into, ArrayType(FloatType())).add("error", StringType())
    return df.mapInArrow(run, schema)


def encode_transcripts(rows: DataFrame, model: Model = SLOTS["gte"]) -> DataFrame:
    """(vid, idx, vec, error) of transcripts (vid, idx, text); blank texts are encoded as one blank."""
    from ..functions.text import fill_blank

    return encode(rows.select("vid", "idx", fill_blank(F.col("text")).alias("text")), "text", model).drop("text")
