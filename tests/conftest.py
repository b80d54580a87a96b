from __future__ import annotations

import json
import os
import sys

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
    )
    if not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", str(home / "checkpoints"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """DataFrame of one text column from a list."""

    def make(values, name="raw"):
        return spark.createDataFrame([(v,) for v in values], f"{name} string")

    return make


def chart(number, kind="COUNTER", **options):
    return {
        "id": number,
        "type": kind,
        "name": f"chart {number}",
        "description": "",
        "options": options,
        "created_at": "2021-05-06T07:08:09.123Z",
    }


def query(**changes):
    asset = {
        "id": 1,
        "version": 1,
        "name": "SampleQuery",
        "query": "SELECT \n1 AS A,\n strpos('x','y') AS B FROM raw_zone.OrdersV1",
        "query_hash": "00000000000000000000000000000001",
        "description": None,
        "schedule": None,
        "tags": [],
        "api_key": "REDACTED",
        "data_source_id": 1,
        "is_draft": False,
        "options": {"parameters": []},
        "user": {"id": 1, "name": "Ann", "email": "ann@example.com", "disabled_at": None},
        "updated_at": "2021-05-06T07:08:09.123Z",
        "visualizations": [
            chart(1, "TABLE"),
            chart(4, "TABLE"),
            chart(2, counterColName="A", rowNumber=1, stringDecimal=0, formatTargetValue=False),
            chart(3, counterLabel="Total", stringThouSep=","),
            chart(5, targetRowNumber=1),
        ],
    }
    return {**asset, **changes}


def widget(number, shown, **changes):
    return {
        "id": number,
        "dashboard_id": 1,
        "width": 1,
        "text": "",
        "options": {"isHidden": False, "position": {"col": 0, "sizeX": 3}},
        "visualization": None if shown is None else {**chart(shown), "query": query()},
        **changes,
    }


def dashboard(**changes):
    asset = {
        "id": 1,
        "slug": "sampledash",
        "name": "SampleDash",
        "tags": [],
        "layout": [],
        "dashboard_filters_enabled": False,
        "is_draft": True,
        "updated_at": "2021-11-02T10:00:00.000Z",
        "widgets": [
            widget(1, 2),
            widget(2, 3, width=0),
            widget(3, 5, width=None, options={}),
            widget(4, None, text="only text", width=2),
        ],
    }
    return {**asset, **changes}


def dumps(asset):
    return json.dumps(asset, ensure_ascii=False)
