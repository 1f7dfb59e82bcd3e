"""SQL text over registered views runs against our tables and agrees with the operators."""

from pyspark.sql import functions as F

from tierlake.operators import aggregates as agg
from tierlake.plans import catalog
from tierlake.queries import agents_current, silver

from conftest import SF_SMALL


def canon(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_sql_over_views_matches_operators(spark):
    s, cur = silver(spark, SF_SMALL), agents_current(spark, SF_SMALL)
    assert catalog.register_views({"silver_property_events": s, "agent_master": cur}) == \
        ["agent_master", "silver_property_events"]
    types = spark.sql("SELECT event_type, sum(int(listing_id IS NOT NULL)) FROM silver_property_events GROUP BY ALL")
    assert canon(types.collect()) == canon(agg.listing_count_by_event(s).collect())
    tiers = spark.sql("""SELECT tier, count(*) FROM agent_master LEFT SEMI JOIN silver_property_events
                         USING (agent_id) GROUP BY tier""")
    active = cur.join(s.select("agent_id").distinct(), "agent_id").groupBy("tier").agg(F.count("agent_id"))
    assert canon(tiers.collect()) == canon(active.collect())
