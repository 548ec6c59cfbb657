"""Row keys and key hashes. They depend on the row alone, never on partitioning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def content_key(*columns: str) -> Column:
    """md5 over all given columns. Exact copies of a row share the key, so a
    split on it never puts copies on both sides."""
    # concat_ws skips nulls, so they are marked first
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK))
                                    for c in columns]))


def file_id(*roots: str) -> Column:
    """A hash of the row's file path below the folders ``roots``.

    The path counts from there on, so a folder that moves or is mounted elsewhere
    keeps its ids. It is hashed to keep the id short; equal prefixes compress well.
    """
    path = F.col("_metadata.file_path")
    for root in roots:
        bare = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", root).strip("/")
        path = F.regexp_replace(path, f"^[a-z0-9]+:/(.*?/)??{re.escape(bare)}/+", "")
    return F.hex(F.xxhash64(path))


def row_address(*roots: str) -> Column:
    """File and row position, ``<file id>#<row>``: tells copies of a row apart."""
    return F.concat_ws("#", file_id(*roots), F.col("_metadata.row_index").cast("string"))


def row_file(address: str) -> Column:
    """The file id in a row's address."""
    return F.substring_index(address, "#", 1)


def key_hash(key: Column | str, seed: str = "") -> Column:
    """32 hex digits, never null; ordering rows by them is a repeatable shuffle."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(NULL_MARK))))


def percentile_bucket(key: Column | str, seed: str = "") -> Column:
    """0 to 99, from the first 32 bits of the key hash."""
    return F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("bigint") % 100
