"""Seeds and draws that follow from a row's identity, whatever the partitioning."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def seed_of(parts: list[str | None]) -> int:
    """64 bits of BLAKE2b over the parts, each with a bar after it but the last; ``*`` for none."""
    return int.from_bytes(hashlib.blake2b("|".join("*" if x is None else x for x in parts).encode(), digest_size=8).digest(), "little")


def seed(*parts: Column) -> Column:
    """The seed of each row's ``parts`` as a decimal, since it has 64 bits without a sign."""

    def made(batch: pa.Array) -> pa.Array:
        return pa.array([str(seed_of(x)) for x in batch.to_pylist()])

    return F.arrow_udf(made, "string")(F.array(*[p.cast("string") for p in parts])).cast("decimal(20,0)")


def draws(seeds: Column, n: int) -> Column:
    """``n`` uniform numbers in [0, 1) from a generator started with each seed."""

    def drawn(batch: pa.Array) -> pa.Array:
        return pa.array([None if s is None else np.random.default_rng(int(s)).random(n).tolist() for s in batch.to_pylist()], pa.list_(pa.float64()))

    return F.arrow_udf(drawn, "array<double>")(seeds.cast("string"))
