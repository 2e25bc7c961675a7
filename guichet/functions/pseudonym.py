"""Keyed pseudonyms for identifiers."""

from __future__ import annotations

import hashlib
import hmac
import os
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guichet import fixed_values as fv

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEFAULT_SECRET_VARIABLE = "GUICHET_HMAC_SECRET"


class MissingSecretError(RuntimeError):
    """Pseudonyms were asked for without a usable secret."""


def secret_from_environment(variable: str = DEFAULT_SECRET_VARIABLE) -> bytes:
    secret = os.environ.get(variable)
    if not secret:
        raise MissingSecretError(f"Environment variable {variable} must hold the pseudonym secret")
    return secret.encode()


def pseudonym(c: Column, secret: bytes) -> Column:
    """``hmac_sha256:`` and the hex HMAC-SHA-256 of the value; NULL stays NULL.

    The secret travels inside the serialised function. As a SQL expression it would
    be readable in query plans and event logs.
    """
    if not secret:
        raise MissingSecretError("The pseudonym secret is empty")
    @F.arrow_udf(T.StringType())
    def sign(values: pa.Array) -> pa.Array:
        state = hmac.new(secret, digestmod=hashlib.sha256)
        out = []
        for value in values.to_pylist():
            if value is None:
                out.append(None)
                continue
            one = state.copy()
            one.update(value.encode())
            out.append(fv.PSEUDONYM_PREFIX + one.hexdigest())
        return pa.array(out, pa.string())

    return sign(c)
