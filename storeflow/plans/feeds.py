"""Sample documents as a feed that arrives over time.

Documents are written once as files in the order of the feed, and published in waves: a stream drains the first wave
and ends, then goes on from its checkpoint with the next.  File times follow the order, so a stream takes
files as they were made (an object store keeps no such times; there the order within a wave is not kept).
"""

from __future__ import annotations

from math import ceil

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from storeflow.plans.lineage import fresh_folder
from storeflow.sources.files import File, Files

# A micro-batch takes about this share of a feed, but never more than the bytes below: a small feed still
# crosses several batch borders, and a batch of a large one fits its cluster.
BATCH_SHARE = 4
BATCH_BYTES = 4 << 30
# Files of a feed, at least.
FEED_FILES = 8
WAVES = 2


def batch_bytes(total: int) -> int:
    """Bytes a micro-batch of a feed of ``total`` bytes admits."""
    return max(1, min(BATCH_BYTES, ceil(total / BATCH_SHARE)))


class Feed:
    """Documents written as ``fmt`` files below a fresh folder; ``inbox`` is what a stream watches."""

    def __init__(self, documents: DataFrame, fmt: str, order: list[str], label: str):
        spark = documents.sparkSession
        base = fresh_folder(spark, label)
        self.inbox, self.archive, self.checkpoint = f"{base}/in", f"{base}/kept", f"{base}/checkpoint"
        self.out = f"{base}/out"
        self.schema = documents.schema
        self._files = Files(spark)
        parts = max(FEED_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
        # Finding the ranges reads the documents once more, so they are kept: nesting is most of the work.
        documents.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = documents.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            rows.write.format(fmt).save(f"{base}/made")
        finally:
            documents.unpersist()
        self._files.make_folder(self.inbox)
        self.waiting: list[File] = self._files.listed(f"{base}/made/part-*")
        sizes = [f.size for f in self.waiting]
        # Files are uneven; without some room a wave would end in a batch of one file.
        self.batch_bytes = min(BATCH_BYTES, batch_bytes(sum(sizes)) + max(sizes, default=0) // 2)
        self._waves = self._cut()
        self._clock = 0

    def _cut(self) -> list[list[File]]:
        size = ceil(len(self.waiting) / WAVES) or 1
        return [self.waiting[i : i + size] for i in range(0, len(self.waiting), size)]

    def newest_first(self) -> None:
        """Publish the last wave first."""
        self._waves.reverse()

    def publish(self) -> bool:
        """Put the next wave into the inbox; False if there is none left."""
        if not self._waves:
            return False
        wave = self._waves.pop(0)
        for file in wave:
            # A second apart, all in the past, in the order of the feed.
            self._clock = max(self._clock + 1000, wave[0].modified - 1000 * len(self.waiting))
            self._files.move(file.path, f"{self.inbox}/{file.name}", self._clock)
        return True
