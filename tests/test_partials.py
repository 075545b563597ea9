"""Gold from kept sums against Gold from events."""

import pytest
from pyspark.sql import functions as F

from pitchlake import schemas
from pitchlake.plans import gold, partials
from pitchlake.plans.commits import CommitStore
from tests import matches


@pytest.fixture
def events(spark):
    frames = [matches.served(spark, schemas.SILVER, i).withColumn("source_version", F.lit(i)) for i in (1, 2, 3)]
    out = frames[0].unionByName(frames[1]).unionByName(frames[2])
    late = out.where("match_id = 1").withColumn("period", F.lit(5)).withColumn("event_id", F.concat("event_id", F.lit("-late")))
    return out.unionByName(late).unionByName(out.where("match_id = 2").withColumn("team_id", F.lit(None).cast(out.schema["team_id"].dataType)))


def rounded(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_parts_give_both_facts(events):
    parts = partials.partial_facts(events)
    assert rounded(partials.team_facts(parts)) == rounded(gold.fact_gold_team(events))
    assert rounded(partials.interval_facts(parts)) == rounded(gold.fact_gold_intervals(events))


def test_parts_of_any_pieces_add_up(events):
    """Events that arrive in pieces, and pieces that were merged before."""
    piece = F.pmod(F.xxhash64("event_id"), F.lit(3))
    pieces = [partials.partial_facts(events.where(piece == k)) for k in range(3)]
    apart = pieces[0].unionByName(pieces[1]).unionByName(pieces[2])
    nested = partials.merged(pieces[0].unionByName(pieces[1])).unionByName(pieces[2].select(partials.merged(pieces[2]).columns))
    for parts in (apart, nested, partials.merged(apart)):
        assert rounded(partials.team_facts(parts)) == rounded(gold.fact_gold_team(events))
        assert rounded(partials.interval_facts(parts)) == rounded(gold.fact_gold_intervals(events))


def test_a_large_match_moves_few_rows(events):
    parts = partials.partial_facts(events)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange")
    assert "HashAggregate" in plan[exchange:] and "SortAggregate" not in plan
    assert parts.groupBy("match_id", "team_id").count().agg(F.max("count")).first()[0] <= 25


def test_state_equals_the_full_rebuild(spark, events, tmp_path):
    """Inserts, a replacement and a held-back match."""
    store = CommitStore(spark, str(tmp_path / "parts"))
    store.commit(partials.partial_facts(events.where("match_id < 3")), "a")
    revised = events.where("match_id > 1 AND event_index > 4").withColumn("source_version", F.lit(9))
    store.commit(partials.partial_facts(revised), "b", check=lambda p: p.where("match_id = 3").select("match_id"))
    current = events.where("match_id = 1").unionByName(revised.where("match_id = 2"))
    for _ in range(2):
        assert rounded(partials.team_facts(store.read())) == rounded(gold.fact_gold_team(current))
        assert rounded(partials.interval_facts(store.read())) == rounded(gold.fact_gold_intervals(current))
        assert rounded(partials.team_facts(store.read(1))) == rounded(gold.fact_gold_team(events.where("match_id < 3")))
        store.compact()
    one = spark.createDataFrame([(2,)], "match_id long")
    assert rounded(partials.team_facts(store.read(matches=one))) == rounded(gold.fact_gold_team(current.where("match_id = 2")))
