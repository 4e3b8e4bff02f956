"""The registered queries; importing a module registers its entries."""

from importlib import import_module

MODULES = [
    "text_jobs", "tables", "vectors", "mapping", "weekly", "backfill", "reports", "operations",
    "clustering", "search", "runs", "planted",
]


def load_all() -> None:
    for m in MODULES:
        import_module(f"{__name__}.{m}")
