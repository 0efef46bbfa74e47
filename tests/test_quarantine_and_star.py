"""Lines that cannot be read or break a rule are set aside; bucketed tables meet without a shuffle."""

import pytest
from pyspark.sql import functions as F

from bidscope.operators import quality
from bidscope.plans import registered, warehouse
from bidscope.sources.csv_files import RESCUED, read_csv_rescued
from tests.conftest import SF_DIR, rows

HEADER = "supply_event_id,timestamp,placement_type,device_type,available_slots,fill_rate,floor_price_usd,note"
LINES = [
    "a,2024-01-01 10:00:00,top_of_search,mobile,3,0.5,0.1,fine",
    "b,2024-01-01 10:00:00,top_of_search,mobile,3.0,0.5,0.1,fine",
    "c,2024-01-01 10:00:00,top_of_search,mobile,3.5,0.5,0.1,half a slot",
    "d,yesterday,top_of_search,mobile,x,high,0.1,three cells",
    "e,2024-01-01 10:00:00,top_of_search,mobile,-1,1.5,0.1,two rules",
    "f,2024-01-01 10:00:00,,mobile,1,0.5,0.1,no placement",
    "g,2024-01-01 10:00:00,top_of_search",
    "h,2024-01-01 10:00:00,top_of_search,mobile,3,0.5,0.1,fine,one more",
    '"i, quoted",2024-01-01 10:00:00,top_of_search,mobile,99999999999,0.5,0.1,too large',
]


@pytest.fixture
def folder(tmp_path):
    def write(*lines, header=HEADER):
        (tmp_path / "supply.csv").mkdir(exist_ok=True)
        (tmp_path / "supply.csv" / f"part-{len(list((tmp_path / 'supply.csv').iterdir()))}.csv").write_text("\n".join([header, *lines]) + "\n")
        return str(tmp_path)

    return write


def test_every_line_is_a_row(spark, folder):
    got = {r["supply_event_id"]: r for r in rows(read_csv_rescued(spark, folder(*LINES), "supply"))}
    assert len(got) == len(LINES)
    lost = {key[0]: r[RESCUED] for key, r in got.items()}
    assert lost["a"] == lost["b"] == lost["e"] == lost["f"] == [] and got["b"]["available_slots"] == 3
    assert lost["c"] == ["available_slots=3.5"] and got["c"]["available_slots"] is None
    assert lost["d"] == ["timestamp=yesterday", "available_slots=x", "fill_rate=high"]
    assert lost["g"] == [f"line={LINES[6]}"] and got["g"]["placement_type"] == "top_of_search"
    assert lost["h"] == [f"line={LINES[7]}"] and lost["i"] == ["available_slots=99999999999"]
    assert got["a"]["note"] == "fine"


def test_accepted_and_rejected_add_up(spark, folder):
    table = read_csv_rescued(spark, folder(*LINES), "supply")
    accepted, rejected = quality.quarantine(table, "fact_supply", rescued=RESCUED)
    assert sorted(r["supply_event_id"] for r in rows(accepted)) == ["a", "b"] and RESCUED not in accepted.columns
    failed = {r["supply_event_id"][0]: r["failed"] for r in rows(rejected)}
    assert failed["c"] == ["unreadable available_slots"]
    assert failed["d"] == ["unreadable available_slots", "unreadable fill_rate", "unreadable timestamp"]
    assert failed["e"] == ["available_slots_not_negative", "fill_rate_0_1"] and failed["f"] == ["placement_type_not_null"]
    assert "unreadable line" in failed["g"] and failed["h"] == ["unreadable line"]
    assert accepted.count() + rejected.count() == len(LINES)
    own = [quality.Rule("cheap", "floor_price_usd < 0.05")]
    assert quality.quarantine(table, "fact_supply", own, RESCUED)[0].count() == 0
    none, also_none = quality.quarantine(table.where("false"), "fact_supply", rescued=RESCUED)
    assert none.count() == also_none.count() == 0


def test_headers_and_schemas_must_be_known(spark, folder):
    folder(*LINES[:1])
    path = folder(*LINES[1:2], header=HEADER.replace("device_type,", "").replace("note", "note,device_type"))
    with pytest.raises(Exception, match="header"):
        read_csv_rescued(spark, path, "supply").collect()
    with pytest.raises(ValueError, match="schema"):
        read_csv_rescued(spark, path, "unknown")
    with pytest.raises(FileNotFoundError):
        read_csv_rescued(spark, path, "auctions")


def test_days_meet_their_campaigns_without_a_shuffle(spark):
    store = registered.campaign_store(spark, SF_DIR)
    days, campaigns = store.table("campaign_days"), store.table("dim_campaign")
    report = warehouse.star_by_campaign(days, campaigns, registered.star.dim_advertiser(spark, SF_DIR))
    plan = report._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "campaign_id" in line)
    depth = len(lines[join]) - len(lines[join].lstrip(" :|+-"))
    below = []
    for line in lines[join + 1 :]:
        if len(line) - len(line.lstrip(" :|+-")) <= depth:
            break
        below.append(line)
    assert any("campaign_days" in line for line in below) and any("dim_campaign" in line for line in below)
    assert not any("Exchange" in line for line in below)
    totals = report.agg(F.sum("n_auctions"), F.sum("n_campaigns")).first()
    facts = registered.auctions(spark, SF_DIR)
    assert tuple(totals) == (facts.count(), facts.select("campaign_id").distinct().count())


def test_days_without_campaign_or_advertiser_keep_their_line(spark, make_auctions):
    facts = make_auctions([{"campaign_id": c} for c in ("c1", "c1", "c2", "gone", None)])
    campaigns = spark.createDataFrame(
        [("c1", "v1", "dsp_display", 10.0), ("c2", "lost", "dsp_display", 5.0), ("c9", "v1", "dsp_display", 1.0)],
        "campaign_id string, advertiser_id string, ad_format string, daily_budget_usd double",
    )
    advertisers = spark.createDataFrame([("v1", "large")], "advertiser_id string, tier string")
    got = rows(warehouse.star_by_campaign(warehouse.campaign_days(facts), campaigns, advertisers))
    assert {(r["tier"], r["campaign_format"]): (r["n_campaigns"], r["n_auctions"]) for r in got} == {
        ("large", "dsp_display"): (1, 2), (None, "dsp_display"): (1, 1), (None, None): (1, 2)
    }
    assert next(r["budget_use"] for r in got if r["tier"]) == 0.18
