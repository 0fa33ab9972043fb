"""Session factory with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; conf keys may use `_` for `.`. Cluster settings given by spark-submit win."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def object_store(endpoint: str, key: str, secret: str, region: str | None = None) -> dict[str, str]:
    """Settings of a session that reads and writes s3a:// paths of an S3-like store."""
    plain = endpoint.startswith("http://")
    base = {"endpoint": endpoint, "access.key": key, "secret.key": secret, "path.style.access": "true", "connection.ssl.enabled": str(not plain).lower()}
    return {f"spark.hadoop.fs.s3a.{k}": v for k, v in (base | ({"endpoint.region": region} if region else {})).items()}
