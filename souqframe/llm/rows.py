"""Texts through Python, one Arrow batch after the other, next to a column that is passed on untouched."""

from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

_MADE: OrderedDict = OrderedDict()
_MADE_LIMIT = 4


def once(key, make: Callable):
    """What `make` returns, kept for the Python worker's later tasks. The oldest of a few is dropped."""
    if key not in _MADE:
        while len(_MADE) >= _MADE_LIMIT:
            _MADE.popitem(last=False)
        _MADE[key] = make()
    return _MADE[key]


class Memo(dict):
    """Remembers a function of its key, for `limit` to twice as many keys: those used of late survive."""

    def __init__(self, function: Callable, limit: int):
        super().__init__()
        self.function, self.limit, self.older = function, limit, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.function(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    names = {column.lower() for column in df.columns}
    while name.lower() in names:
        name += "_"
    return name


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    make: Callable[[], Callable],
    fields: list[StructField],
) -> DataFrame:
    """The columns `keep` of every row, and `fields` worked out from its text in the Python worker.

    `make()` is called once a task; what it returns takes a text (or None) and gives one value for
    each field. A kept column that has the name of a field is left out, whatever letters it is in.
    Other columns of `df` are not read.
    """
    new = {field.name.lower() for field in fields}
    keep = [name for name in keep if name.lower() not in new]
    inner = df.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("kept"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    kept_schema = inner.schema["kept"].dataType
    schema = StructType([*kept_schema.fields, *fields])
    arrow_fields = [to_arrow_schema(StructType([field])).field(0) for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            rows = [function(text.as_py()) for text in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow_fields)
            arrays = [
                pa.array(column, type=field.type)
                for column, field in zip(columns, arrow_fields, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.column(0).flatten(), *arrays],
                names=[*keep, *(field.name for field in fields)],
            )

    return inner.mapInArrow(run, schema)
