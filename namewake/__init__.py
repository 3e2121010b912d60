"""namewake: keep a wide, denormalised table in step with its dimension feeds."""

from namewake.entities import ENTITIES, EntitySpec

__all__ = ["ENTITIES", "EntitySpec"]
