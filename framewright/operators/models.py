"""Contract of models that give structs: detectors, text readers, speech. Batch in, values out, errors by row.

A runner is a name and a loader; the loader runs once in each Python worker and gives a function from a list of
inputs to a list of outputs of the declared type. As in encoders, a failing batch is tried value by value.
No weights come with this library; tests bring stand-ins of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StringType, StructType

#: What the slots give for each input. A detector's boxes are centre and size in the padded square.
DETECTIONS = "array<struct<cx:double,cy:double,w:double,h:double,obj:double,shift:double,scale:double,emb:array<double>>>"
LINES = "array<struct<quad:array<struct<x:double,y:double>>,line:string,p:double>>"
SPEECH = "string"

_loaded: dict[str, Callable[[list], list]] = {}


@dataclass(frozen=True)
class Runner:
    name: str
    gives: str  # a type, as DDL
    load: Callable[[], Callable[[list], list]]
    batch: int = 16


def _type(ddl: str) -> DataType:
    return StructType.fromDDL(f"x {ddl}").fields[0].dataType


def apply(df: DataFrame, column: str, runner: Runner, into: str) -> DataFrame:
    """df with `into`, the model's output for `column`, and `error`, null where it worked; columns so called are replaced."""
    gives, name, load, size = _type(runner.gives), runner.name, runner.load, runner.batch
    kind = to_arrow_type(gives)

    def one(f, value):
        try:
            return f([value])[0], None
        except Exception as e:  # noqa: BLE001  one bad value must not lose the rest
            return None, f"{type(e).__name__}: {e}"

    def run(batches):
        f = _loaded.get(name) or _loaded.setdefault(name, load())
        for b in batches:
            at = b.schema.get_field_index(column)
            for i in range(0, b.num_rows, size):
                some = b.slice(i, size)
                values = some.column(at).to_pylist()
                try:
                    got = f(values)
                    if len(got) != len(values):
                        raise ValueError(f"{len(got)} outputs of {len(values)} inputs")
                    got = [(x, None) for x in got]
                except Exception:  # noqa: BLE001
                    got = [one(f, v) for v in values]
                keep = [k for k, c in enumerate(b.schema.names) if c not in (into, "error")]
                yield pa.RecordBatch.from_arrays([*(some.column(k) for k in keep), pa.array([x for x, _ in got], kind), pa.array([e for _, e in got], pa.string())], [*(b.schema.names[k] for k in keep), into, "error"])

    schema = StructType([f for f in df.schema.fields if f.name not in (into, "error")]).add(into, gives).add("error", StringType())
    return df.mapInArrow(run, schema)
