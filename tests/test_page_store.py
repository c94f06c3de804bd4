"""How a page store is written."""

import re

from racelake.sources import pages, staging


def test_a_store_is_written_without_a_sort(spark):
    found = spark.range(500).selectExpr("id as page_id", "concat('https://r/', id % 90) as url", "repeat('<p>', 50) as html", "'t' as scraped_at_utc")
    store = pages.store(found, staging.table_name("unsorted"), 6)
    assert store.count() == 500 and len(store.inputFiles()) <= 6 and all(".zstd." in f for f in store.inputFiles())
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {re.search(r'unsorted_[0-9a-f]+', store.inputFiles()[0])[0]}").collect()}
    assert described["Num Buckets"] == "6" and described["Sort Columns"] == "[]"
