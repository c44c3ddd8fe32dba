"""SRC8, PRJ2-3, INC4: stamp the current bounty table with a snapshot date.

Map-only projection of the full table. As in the source, the snapshot holds the
table's state at run time, labelled with the run's date ``ds``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounty_snapshot(bounties: DataFrame, ds: date) -> DataFrame:
    return bounties.select(
        "bounty_id", "title", "description", F.col("bountyStage").alias("bounty_stage"),
        "usd_price", "user_id", "deadline", "created", F.lit(ds).alias("ymd"),
    )
