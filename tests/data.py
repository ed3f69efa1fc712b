"""Small transaction tables with the shapes the driver tables lack."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
from pyspark.sql import types as T

from ledgerlens.schema import TRANSACTION_SCHEMA

BASE = dt.datetime(2024, 3, 1, 12, 0, 0)


def row(i: int, user: str, seconds: float, **values) -> dict:
    return {
        "transaction_id": f"T{i:05d}",
        "user_id": user,
        "timestamp": BASE + dt.timedelta(seconds=seconds),
        "amount": 10.0,
        "merchant_id": "M1",
        "merchant_category": "restaurant",
        "location_lat": 0.0,
        "location_lon": 0.0,
        "device_id": "D1",
        "is_online": False,
        "is_fraud": 0,
        "card_last_4": None,
        "cvv_provided": None,
        **values,
    }


def table(spark, rows: list[dict]):
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in TRANSACTION_SCHEMA])
    return spark.createDataFrame([tuple(r[f.name] for f in nullable) for r in rows], nullable)


def bursts(n: int, seed: int, users: int = 4, span: int = 4000) -> list[dict]:
    """Bursty rows of a few users, the first one holding more than half of them.

    Seconds and whole timestamps repeat, and gaps longer than a day occur.
    """
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < 0.6 else rng.randrange(1, users)
        second = rng.choice([rng.randrange(span), rng.randrange(60), 500 + rng.randrange(5), 200_000 + rng.randrange(30)])
        micros = rng.choice([0, 0, 0.25, 0.75])
        rows.append(
            row(
                i,
                f"U{user}",
                second + micros,
                amount=rng.choice([5.0, 150.0, 250.0, 600.0, 1200.0]),
                location_lat=rng.choice([0.0, 0.5, 30.0]),
                location_lon=rng.choice([0.0, 1.5, -40.0]),
                device_id=rng.choice(["D1", "D1", "D2", "D3"]),
            )
        )
    return rows


def brute_force(rows: list[dict], horizon: int = 300) -> pd.DataFrame:
    """Previous transaction and range count of every row, one by one."""
    out = []
    for user in sorted({r["user_id"] for r in rows}):
        mine = sorted((r for r in rows if r["user_id"] == user), key=lambda r: (r["timestamp"], r["transaction_id"]))
        for i, r in enumerate(mine):
            now = int((r["timestamp"] - BASE).total_seconds() // 1)
            inside = [
                o for o in mine if now - horizon <= int((o["timestamp"] - BASE).total_seconds() // 1) <= now
            ]
            before = mine[i - 1] if i else None
            out.append(
                (
                    r["transaction_id"],
                    before["timestamp"] if before else None,
                    before["device_id"] if before else None,
                    before["location_lat"] if before else None,
                    before["location_lon"] if before else None,
                    len(inside),
                )
            )
    columns = ["transaction_id", "prev_timestamp", "prev_device", "prev_lat", "prev_lon", "count"]
    return pd.DataFrame(out, columns=columns).sort_values("transaction_id").reset_index(drop=True)


def as_rows(df, *columns: str) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*columns).collect())
