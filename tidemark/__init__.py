"""Change-data-capture lakehouse jobs written as PySpark DataFrame programs."""

from tidemark.session import configure
from tidemark.specs import CUSTOMER, EVENTS, ORDERS, USERS, EntitySpec, FieldSpec

__all__ = ["CUSTOMER", "EVENTS", "ORDERS", "USERS", "EntitySpec", "FieldSpec", "configure"]
