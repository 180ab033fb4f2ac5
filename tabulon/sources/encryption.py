"""Keys for documents and blobs: a service that wraps keys, one in memory for tests, and managers that use it.

Ciphers are the JVM's (AES in GCM); data files are left to Parquet's own
encryption, which Spark's writer options turn on.
"""

from __future__ import annotations

import os
import struct
from abc import ABC, abstractmethod

from pyspark.sql import SparkSession

_NONCE, _TAG_BITS = 12, 128


class KeyService(ABC):
    """Wraps data keys with master keys that it never gives away."""

    @abstractmethod
    def wrap(self, key: bytes, master: str) -> bytes: ...
    @abstractmethod
    def unwrap(self, wrapped: bytes, master: str) -> bytes: ...

    def generate(self, master: str, size: int = 16) -> tuple[bytes, bytes]:
        """A new data key, and its wrapped form."""
        key = os.urandom(size)
        return key, self.wrap(key, master)


def _cipher(spark: SparkSession, key: bytes, nonce: bytes, data: bytes, mode: int, about: bytes) -> bytes:
    if len(key) not in (16, 24, 32):
        raise ValueError("a key has 16, 24 or 32 bytes")
    jvm = spark.sparkContext._jvm
    c = jvm.javax.crypto.Cipher.getInstance("AES/GCM/NoPadding")
    c.init(mode, jvm.javax.crypto.spec.SecretKeySpec(bytearray(key), "AES"), jvm.javax.crypto.spec.GCMParameterSpec(_TAG_BITS, bytearray(nonce)))
    c.updateAAD(bytearray(about))
    return bytes(c.doFinal(bytearray(data)))


def seal(spark: SparkSession, key: bytes, data: bytes, about: bytes = b"") -> bytes:
    nonce = os.urandom(_NONCE)
    return nonce + _cipher(spark, key, nonce, data, 1, about)


def open_sealed(spark: SparkSession, key: bytes, sealed: bytes, about: bytes = b"") -> bytes:
    """An error if the data or what it is about has been changed."""
    try:
        return _cipher(spark, key, sealed[:_NONCE], sealed[_NONCE:], 2, about)
    except Exception as e:
        if "BadTag" in str(e) or len(sealed) < _NONCE + _TAG_BITS // 8:
            raise ValueError("the data cannot be opened with this key") from e
        raise


class MemoryKeyService(KeyService):
    """Master keys in the driver's memory: for tests."""

    def __init__(self, spark: SparkSession, masters: dict[str, bytes]) -> None:
        self.spark, self.masters = spark, dict(masters)

    def _master(self, name: str) -> bytes:
        if name not in self.masters:
            raise ValueError(f"no master key {name!r}")
        return self.masters[name]

    def wrap(self, key: bytes, master: str) -> bytes:
        return seal(self.spark, self._master(master), key, master.encode())

    def unwrap(self, wrapped: bytes, master: str) -> bytes:
        return open_sealed(self.spark, self._master(master), wrapped, master.encode())


class Plaintext:
    """Leaves everything as it is."""

    def encrypt(self, data: bytes, about: bytes = b"") -> bytes:
        return data

    def decrypt(self, data: bytes, about: bytes = b"") -> bytes:
        return data


class Envelope:
    """A new key for every document, wrapped in front of it."""

    def __init__(self, spark: SparkSession, service: KeyService, master: str) -> None:
        self.spark, self.service, self.master = spark, service, master

    def encrypt(self, data: bytes, about: bytes = b"") -> bytes:
        key, wrapped = self.service.generate(self.master)
        return struct.pack(">I", len(wrapped)) + wrapped + seal(self.spark, key, data, about)

    def decrypt(self, data: bytes, about: bytes = b"") -> bytes:
        if len(data) < 4 or len(data) < 4 + (size := struct.unpack_from(">I", data)[0]):
            raise ValueError("no encrypted document")
        return open_sealed(self.spark, self.service.unwrap(data[4 : 4 + size], self.master), data[4 + size :], about)
