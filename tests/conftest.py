import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bidscope.operators.enrich import derive_auction_columns  # noqa: E402
from bidscope.plans import registered  # noqa: E402
from bidscope.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
# The smallest tables that reach past the release date, and whose auction ids are unique.
CHECK_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="bidscope-tests-")
    session = build_session(
        "bidscope-tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def auctions(spark):
    return registered.auctions(spark, SF_DIR).persist()


@pytest.fixture(scope="session")
def supply(spark):
    return registered.supply(spark, SF_DIR).persist()


@pytest.fixture
def make_auctions(spark):
    """Raw auctions from a few dicts; what a dict leaves out has a plain value."""

    def make(rows, derive=True, drop=()):
        full = []
        for i, row in enumerate(rows):
            base = {
                "auction_id": f"a{i:04d}",
                "timestamp": "2024-01-01 10:00:00",
                "placement_type": "top_of_search",
                "device_type": "mobile",
                "ad_format": "sponsored_brand",
                "category": "books",
                "campaign_id": "c1",
                "advertiser_id": "v1",
                "auction_depth": 3,
                "bid_floor_usd": 0.5,
                "winning_bid_usd": 1.0,
                "clearing_price_usd": 0.9,
                "ecpm": 10.0,
                "filled": 1,
                "clicked": 0,
                "converted": 0,
                "revenue_usd": 0.9,
                "release_period": "pre",
                "treatment": 0,
            }
            full.append({**base, **row})
        ddl = (
            "auction_id string, timestamp string, placement_type string, device_type string, ad_format string, "
            "category string, campaign_id string, advertiser_id string, auction_depth int, bid_floor_usd double, "
            "winning_bid_usd double, clearing_price_usd double, ecpm double, filled int, clicked int, "
            "converted int, revenue_usd double, release_period string, treatment int"
        )
        df = spark.createDataFrame(full, ddl).drop(*drop)
        df = df.withColumn("timestamp", df["timestamp"].cast("timestamp_ntz"))
        return derive_auction_columns(df) if derive else df

    return make


def rows(df):
    return [row.asDict() for row in df.collect()]
