"""Where the lake's tables live, and where a session may write scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tarn.functions.clock import RunStamp

SHARED_FOLDER_CONF = "spark.checkpoint.dir"


@dataclass(frozen=True)
class LakePaths:
    """Folders of one subject under one lake root (any Hadoop file system)."""

    root: str
    table: str = "breweries"

    def raw_month(self, run: RunStamp) -> str:
        return f"{self.root}/raw/{self.table}/{run.month}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.table}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/{self.table}"

    def metadata(self, zone: str) -> str:
        return f"{self.root}/metadata/{zone}/{self.table}"

    def control(self, zone: str) -> str:
        return f"{self.root}/control/{zone}/{self.table}"


def listed_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """The size of all files below ``path``. Lists them and opens none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def scratch_folder(spark: SparkSession) -> str:
    """A new, unused folder that every executor can reach.

    All of an application's lie in one folder named after it, which can go when
    nothing that the application returned is read any more.
    It lies under the shared folder the cluster names in
    ``spark.checkpoint.dir``. A machine-local folder is used only by a
    local-mode session that names none, as in tests.
    """
    shared = spark.conf.get(SHARED_FOLDER_CONF, None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {SHARED_FOLDER_CONF} to a folder all executors share")
        shared = tempfile.gettempdir()
    application = spark.conf.get("spark.app.id", "session")
    return f"{shared.rstrip('/')}/tarn-{application}/{uuid.uuid4().hex}"
