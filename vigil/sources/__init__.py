from vigil.sources.tables import read_table
from vigil.sources.fixtures import card, shop

__all__ = ["read_table", "card", "shop"]
