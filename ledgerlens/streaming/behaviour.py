"""Behavioural features on a stream, with one small state per user.

Rows wait until the watermark has passed their second; then they are put in
(timestamp, id) order and compared with the user's state. For data no later
than the watermark delay the result equals the batch features. The state holds
the last transaction, the counts of the last five minutes and the waiting rows.
A micro-batch is bounded by the source's intake limit (rows, files or bytes per
trigger), and so is what one user can bring into one task.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerlens.functions.features import add, amount_columns, merchant_columns, time_columns
from ledgerlens.functions.rules import BEHAVIOUR_RULES, apply_rules, confusion_flags
from ledgerlens.operators.history import (
    COUNT_WINDOW_SECONDS,
    KM_PER_DEGREE,
    NO_PREVIOUS_GAP,
    RAPID_GAP_SECONDS,
    TRAVEL_KM,
    TRAVEL_SECONDS,
)
from ledgerlens.schema import BEHAVIOUR_OUTPUT, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

# Executors get these functions by value; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_SCHEMA = (
    "last_us long, last_lat double, last_lon double, last_device string,"
    " seconds array<long>, counts array<long>, waiting binary"
)
OUTPUT_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in TRANSACTION_SCHEMA]
    + [
        T.StructField("timestamp_seconds", T.LongType()),
        T.StructField("prev_timestamp", T.TimestampType()),
        T.StructField("prev_lat", T.DoubleType()),
        T.StructField("prev_lon", T.DoubleType()),
        T.StructField("prev_device", T.StringType()),
        T.StructField("txn_count_5min", T.LongType()),
        T.StructField("time_since_last_txn", T.LongType()),
        T.StructField("is_rapid_transaction", T.IntegerType()),
        T.StructField("distance_from_prev", T.DoubleType()),
        T.StructField("is_impossible_travel", T.IntegerType()),
        T.StructField("device_changed", T.IntegerType()),
    ]
)


_ARROW_TYPES = {
    "string": pa.string(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "timestamp": pa.timestamp("us"),
}
_WAITING_SCHEMA = pa.schema([(f.name, _ARROW_TYPES[f.dataType.simpleString()]) for f in TRANSACTION_SCHEMA])
_MICROS = 1_000_000

# Rows of one user are kept as one array per column: groups are often tiny, and
# the fixed cost of DataFrame operations would outweigh the work itself.
Columns = dict[str, np.ndarray]


def _pack(rows: Columns) -> bytes:
    arrays = [pa.array(rows[f.name], type=f.type, from_pandas=True) for f in _WAITING_SCHEMA]
    batch = pa.RecordBatch.from_arrays(arrays, schema=_WAITING_SCHEMA)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _WAITING_SCHEMA) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> Columns:
    table = pa.ipc.open_stream(data).read_all()
    return {f.name: table.column(f.name).to_numpy() for f in _WAITING_SCHEMA}


def _columns(pdf: pd.DataFrame) -> Columns:
    rows = {c: pdf[c].to_numpy() for c in TRANSACTION_COLUMNS}
    rows["timestamp"] = rows["timestamp"].astype("datetime64[us]")
    return rows


def _take(rows: Columns, which: np.ndarray) -> Columns:
    return {c: values[which] for c, values in rows.items()}


def _behind(first: Any, values: np.ndarray) -> np.ndarray:
    """Each value's predecessor; ``first`` precedes the first one."""
    return np.concatenate([np.array([first], dtype=values.dtype), values[:-1]])


def _features(rows: Columns, last: tuple, seconds: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
    """Compare ordered rows of one user with each other and with the state."""
    last_us, last_lat, last_lon, last_device = last
    micros = rows["timestamp"].astype("int64")
    now = micros // _MICROS
    known = np.ones(len(now), dtype=bool)
    known[0] = last_us is not None
    previous = _behind(last_us if last_us is not None else 0, micros)
    prev_time = previous.astype("datetime64[us]")
    prev_time[~known] = np.datetime64("NaT")
    prev_lat = _behind(np.nan if last_lat is None else last_lat, rows["location_lat"])
    prev_lon = _behind(np.nan if last_lon is None else last_lon, rows["location_lon"])
    prev_device = _behind(last_device, rows["device_id"].astype(object))

    # Range count: transactions up to this second minus those before the window.
    at = np.concatenate([seconds, now])
    running = np.concatenate([[0], np.cumsum(np.concatenate([counts, np.ones(len(now), dtype="int64")]))])
    upto = running[np.searchsorted(at, now, side="right")]
    before = running[np.searchsorted(at, now - COUNT_WINDOW_SECONDS, side="left")]

    gap = np.where(known, now - previous // _MICROS, NO_PREVIOUS_GAP)
    north, east = rows["location_lat"] - prev_lat, rows["location_lon"] - prev_lon
    distance = np.nan_to_num(np.sqrt(north**2 + east**2) * KM_PER_DEGREE, nan=0.0)
    return pd.DataFrame(
        {
            **rows,
            "timestamp": rows["timestamp"].astype("datetime64[ns]"),
            "timestamp_seconds": now,
            "prev_timestamp": prev_time.astype("datetime64[ns]"),
            "prev_lat": prev_lat,
            "prev_lon": prev_lon,
            "prev_device": prev_device,
            "txn_count_5min": upto - before,
            "time_since_last_txn": gap,
            "is_rapid_transaction": (gap < RAPID_GAP_SECONDS).astype("int32"),
            "distance_from_prev": distance,
            "is_impossible_travel": ((distance > TRAVEL_KM) & (gap < TRAVEL_SECONDS)).astype("int32"),
            "device_changed": (known & (rows["device_id"] != prev_device)).astype("int32"),
        }
    )


def _advance(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    # Spark pads its output batches with empty rows, which pandas comments on.
    warnings.filterwarnings("ignore", message="The behavior of DataFrame concatenation", category=FutureWarning)
    last, waiting = (None, None, None, None), None
    seconds = counts = np.array([], dtype="int64")
    if state.exists:
        *held, held_seconds, held_counts, waiting = state.get
        last = tuple(held)
        seconds, counts = np.array(held_seconds, dtype="int64"), np.array(held_counts, dtype="int64")

    parts = [] if waiting is None else [_unpack(waiting)]
    if not state.hasTimedOut:
        parts += [_columns(b) for b in batches if len(b)]
    if not parts:
        return
    rows = parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in TRANSACTION_COLUMNS}

    # A second is complete once the watermark has passed its end.
    watermark = max(state.getCurrentWatermarkMs(), 0)
    closed = watermark // 1000
    second = rows["timestamp"].astype("int64") // _MICROS
    done = second < closed

    if done.any():
        ready = _take(rows, done)
        ready = _take(ready, np.lexsort((ready["transaction_id"].astype("U"), ready["timestamp"])))
        yield _features(ready, last, seconds, counts)
        last = (
            int(ready["timestamp"][-1].astype("int64")),
            float(ready["location_lat"][-1]),
            float(ready["location_lon"][-1]),
            ready["device_id"][-1],
        )
        new_seconds, new_counts = np.unique(second[done], return_counts=True)
        seconds, counts = np.concatenate([seconds, new_seconds]), np.concatenate([counts, new_counts])

    recent = seconds >= closed - COUNT_WINDOW_SECONDS
    rest = None if done.all() else _pack(_take(rows, ~done))
    state.update((*last, seconds[recent].tolist(), counts[recent].tolist(), rest))
    if rest is not None:
        due = (int(second[~done].min()) + 1) * 1000 - 1
        state.setTimeoutTimestamp(max(due, watermark + 1))


def behaviour_stream(transactions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Transactions with the behavioural features, in append mode."""
    return (
        transactions.withWatermark("timestamp", delay)
        .select(*TRANSACTION_COLUMNS)
        .groupBy("user_id")
        .applyInPandasWithState(
            _advance, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def score_behaviour_stream(transactions: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """The behavioural rules on a stream, in the layout of the batch scorer."""
    amounts = amount_columns()
    featured = add(
        behaviour_stream(transactions, delay),
        {
            **time_columns(),
            "amount_log": amounts["amount_log"],
            "amount_category": amounts["amount_category"],
            "is_high_risk_merchant": merchant_columns()["is_high_risk_merchant"],
        },
    )
    return confusion_flags(apply_rules(featured, BEHAVIOUR_RULES)).select(*BEHAVIOUR_OUTPUT)
