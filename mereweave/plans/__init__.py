"""Views over the driver's tables, and the registered queries with their SQL oracles."""

from importlib import import_module

#: Modules that register queries when imported.
MODULES = ("reports", "events", "ledger", "documents", "kg", "streams", "supplement", "handlers", "content", "delivery", "mailboxes", "entities", "triples", "taxonomies", "times", "sites", "landed", "social")


def load():
    """Imports every query module and returns the registry."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
