"""A document query engine on Spark: declared entities, composable lazy queries, includes, vector search and saves."""

from docquery.operators.query import Query
from docquery.plans.model import EntityType, Model, Nav, Prop
from docquery.sources.session import Session

__all__ = ["EntityType", "Model", "Nav", "Prop", "Query", "Session"]
