"""Raw-file landing as set-at-a-time manifest classification.

Input is a manifest frame: one row per *incoming* file with a logical name,
a content fingerprint and an arrival sequence (``landed_seq``; larger =
observed later). Every function classifies all incoming files in one job;
nothing is copied file by file on the driver.

Scale notes: the per-name reference row is an aggregate (``min_by``), so a
name with many arrivals is combined map-side; joining it back is an equi
join on the name that AQE's skew handling splits if one name is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import SHA_PREFIX_LEN, sha_prefix

# Landing outcomes.
LANDED = "landed"
DUPLICATE = "duplicate"
COLLISION = "collision"
REUSED = "reused"


def classify_immutable(manifest: DataFrame, name_col: str = "name", sha_col: str = "content_sha",
                       seq_col: str = "landed_seq") -> DataFrame:
    """Immutable landing: the first file under a name wins forever.

    * first arrival of a name            -> ``landed``
    * same name, same bytes (same SHA)   -> ``duplicate`` (no-op, points at the landed file)
    * same name, different bytes         -> ``collision`` (an error naming both SHA prefixes)
    """
    firsts = (manifest.groupBy(name_col)
              .agg(F.min_by(F.col(sha_col), F.col(seq_col)).alias("_first_sha"),
                   F.min(seq_col).alias("_first_seq")))
    j = manifest.join(firsts, name_col)
    status = (F.when(F.col(seq_col) == F.col("_first_seq"), F.lit(LANDED))
              .when(F.col(sha_col) == F.col("_first_sha"), F.lit(DUPLICATE))
              .otherwise(F.lit(COLLISION)))
    message = F.when(
        status == COLLISION,
        F.concat(F.lit("immutable raw file "), F.col(name_col).cast("string"),
                 F.lit(" already landed with sha256 "), sha_prefix("_first_sha"),
                 F.lit(", incoming sha256 "), sha_prefix(sha_col)))
    return (j.withColumn("landing_status", status)
             .withColumn("landing_error", message)
             .withColumn("landed_sha", F.col("_first_sha"))
             .drop("_first_sha", "_first_seq"))


def version_names(manifest: DataFrame, stem_col: str = "stem", sha_col: str = "content_sha",
                  seq_col: str = "landed_seq", suffix: str = ".json") -> DataFrame:
    """Versioned landing: one stored file per distinct content of a stem.

    The first content of a stem is stored as ``{stem}{suffix}``; any other
    content as ``{stem}__{sha[:12]}{suffix}``; identical content reuses the
    existing file. Returns one row per (stem, content) version with the
    first and last arrival sequence and the number of arrivals.
    """
    versions = (manifest.groupBy(stem_col, sha_col)
                .agg(F.min(seq_col).alias("first_seq"), F.max(seq_col).alias("last_seq"),
                     F.count(F.lit(1)).alias("arrivals")))
    plain = (versions.groupBy(stem_col)
             .agg(F.min_by(F.col(sha_col), F.col("first_seq")).alias("_plain_sha")))
    stem_txt = F.col(stem_col).cast("string")
    name = F.when(F.col(sha_col) == F.col("_plain_sha"), F.concat(stem_txt, F.lit(suffix))) \
            .otherwise(F.concat(stem_txt, F.lit("__"), sha_prefix(sha_col, SHA_PREFIX_LEN), F.lit(suffix)))
    return (versions.join(plain, stem_col)
                    .withColumn("version_name", name)
                    .drop("_plain_sha"))


def classify_versioned(manifest: DataFrame, stem_col: str = "stem", sha_col: str = "content_sha",
                       seq_col: str = "landed_seq", suffix: str = ".json") -> DataFrame:
    """Per incoming file: the version it is stored under and landed/reused."""
    v = version_names(manifest, stem_col, sha_col, seq_col, suffix).select(
        stem_col, sha_col, "version_name", "first_seq")
    return (manifest.join(v, [stem_col, sha_col])
                    .withColumn("landing_status",
                                F.when(F.col(seq_col) == F.col("first_seq"), F.lit(LANDED))
                                 .otherwise(F.lit(REUSED)))
                    .drop("first_seq"))


def base_name(name_col, suffix: str = ".json"):
    """Strip an optional ``__<12 hex>`` version tag and the suffix."""
    suffix_re = suffix.replace(".", r"\.")
    return F.regexp_extract(F.col(name_col) if isinstance(name_col, str) else name_col,
                            rf"^(.+?)(__[0-9a-f]{{{SHA_PREFIX_LEN}}})?{suffix_re}$", 1)


def latest_versions(versions: DataFrame, name_col: str = "version_name",
                    seq_col: str = "last_seq", suffix: str = ".json") -> DataFrame:
    """The latest stored version per logical name (base name), by arrival order.

    Arrival order, not file modification time: copies and restores reset
    mtimes, the manifest sequence does not.
    """
    with_base = versions.withColumn("base_name", base_name(name_col, suffix))
    return (with_base.groupBy("base_name")
            .agg(F.max_by(F.col(name_col), F.col(seq_col)).alias("latest_name"),
                 F.max(seq_col).alias("latest_seq"),
                 F.count(F.lit(1)).alias("versions")))
