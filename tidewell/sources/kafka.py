"""Broker topics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Fixed value: records one trigger takes at most.
MAX_OFFSETS_PER_TRIGGER = 1_000_000


@dataclass(frozen=True)
class KafkaSource:
    bootstrap_servers: str
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER
    extra: dict[str, str] = field(default_factory=dict)

    def options(self, topics: Sequence[str]) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": ",".join(topics),
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
            "failOnDataLoss": "false",
            **self.extra,
        }

    def stream(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        """Records of one or more topics."""
        return spark.readStream.format("kafka").options(**self.options(topics)).load()
