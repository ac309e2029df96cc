"""Query definitions over the given tables."""


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    import pkgutil

    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
