"""Tables of a test tracker from landed payloads: runs, statuses, containers of tests, tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import dedup_any, dedup_latest
from tidemark.operators.history import upsert
from tidemark.operators.semi import parse_payload

#: The payloads' fields. Runs may carry more, given by the caller.
CONTAINER = ["container_issue_id", "container_issue_key", "container_summary", "test_issue_id", "test_issue_key"]
STATUS = ["name", "description", "color"]
TEST = ["test_issue_id", "test_issue_key", "test_summary", "test_type", "steps_json"]


def _parsed(landed: DataFrame, columns: list[str], source: str) -> DataFrame:
    return parse_payload(landed, ", ".join(f"`{c}` string" for c in columns), source)


def test_runs(landed: DataFrame, columns: list[str], target: DataFrame | None = None, source: str = "raw_data") -> DataFrame:
    """One row a run_id, upserted into ``target``: the landing that finished last, unfinished ones last; ties fall to the
    largest started_on and status_name. Bad instants become null; rows without a run_id go."""
    rows = _parsed(landed, columns, source).where("run_id is not null")
    rows = rows.withColumns({c: F.try_to_timestamp(F.col(c)) for c in ("started_on", "finished_on")})
    return upsert(target, dedup_latest(rows, ["run_id"], "finished_on", ["started_on", "status_name"]), ["run_id"])


def statuses(landed: DataFrame, target: DataFrame | None = None, source: str = "raw_data") -> DataFrame:
    """One row a status name, whichever landing it comes from."""
    return upsert(target, dedup_any(_parsed(landed, STATUS, source).where("name is not null"), ["name"]), ["name"])


def containers(landed: DataFrame, kind: str, target: DataFrame | None = None, source: str = "raw_data") -> DataFrame:
    """One row a container and test, under ``kind``'s column names; a container without tests keeps a row whose test is null."""
    rows = _parsed(landed, CONTAINER, source).where("container_issue_id is not null")
    rows = rows.withColumnsRenamed({c: c.replace("container", kind) for c in CONTAINER})
    keys = [f"{kind}_issue_id", "test_issue_id"]
    return upsert(target, dedup_any(rows, keys), keys)


def tests(landed: DataFrame, target: DataFrame | None = None, source: str = "raw_data") -> DataFrame:
    """One row a test; its steps stay a JSON text."""
    return upsert(target, dedup_any(_parsed(landed, TEST, source).where("test_issue_id is not null"), ["test_issue_id"]), ["test_issue_id"])
