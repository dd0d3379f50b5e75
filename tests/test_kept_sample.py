"""A sample that is kept between deliveries equals one draw over all of them."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from test_tables import ODD, feedback

from feedloom.plans.staging import fresh_path
from feedloom.sources.bounds import sample_threshold
from feedloom.sources.kept import KeptSample


def drawn(df):
    return sorted((r.game_name or "", r.content_id) for r in df.collect())


def test_deliveries_in_any_order_and_again(spark):
    rng = random.Random(3)
    rows = [(f"i{i}", rng.choice(["g", "g", "g", ODD, None]), "text", "2024-01-01") for i in range(300)]
    expected = drawn(sample_threshold(feedback(spark, rows), ["game_name"], "content_id", 15))
    kept = KeptSample(spark, fresh_path(spark, "sample"), ["game_name"], "content_id", 15)
    assert kept.rows() is None
    for part in (rows[100:220], rows[:150], rows[100:220], [], rows[150:]):
        schema_rows = feedback(spark, part or rows[:1]).limit(len(part))
        kept.extend(schema_rows)
        assert len(kept._versions()) == 1
    assert drawn(kept.rows()) == expected


def test_few_rows_and_copies(spark):
    kept = KeptSample(spark, fresh_path(spark, "sample"), ["game_name"], "content_id", 5)
    kept.extend(feedback(spark, [("1", "g", "old", "2024-01-01"), ("1", "g", "new", "2024-01-02"), ("2", "h", "x", None)]))
    kept.extend(feedback(spark, [("1", "g", "newest", "2024-02-01"), ("3", "g", "y", None)]))
    found = {(r.content_id, r.content_text) for r in kept.rows().where(F.lit(True)).collect()}
    assert found == {("1", "new"), ("2", "x"), ("3", "y")}
