"""A spread of registered queries against their SQL at the smallest scale."""

import os

import pytest
from compare import compare, database, entry_module

from tagloom import registry

SF = "/root/testdata/sf0.001"
#: Whole runs and iterative operators take longest; they run in the check of all entries (tests/compare.py), or with TAGLOOM_ALL=1.
LONG = {
    "communities", "communities_planted", "graph_sweep", "density_cluster", "density_planted", "tune_density", "cluster_labels_run", "weekly_run",
    "backfill_run", "map_stream", "stream_equals_batch", "status_windows", "anomaly_state", "upsert_anomaly_clusters", "materialize_taxonomy",
    "promote_clusters", "promote_outputs", "connected_components", "graph_metrics", "pca3", "tune_density_planted", "condense_levels_planted",
    "graph_sweep_planted", "cluster_labels_planted", "weekly_run_rows", "backfill_run_rows", "approximate_knn", "indexed_search", "indexed_top_k",
}
NAMES = list(registry.ENTRIES) if os.environ.get("TAGLOOM_ALL") else [n for n in registry.ENTRIES if n not in LONG]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    assert compare(spark, database(SF), name, SF) is None


def test_registry_is_whole():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
