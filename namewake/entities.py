"""What differs between the eight dimension jobs, as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Columns that lead every change record, all nullable text.
ENVELOPE = ("table1", "op_type", "op_ts", "current_ts", "pos")

# Change kinds carried by op_type.
INSERT, UPDATE, DELETE = "I", "U", "D"


@dataclass(frozen=True)
class EntitySpec:
    """One dimension: its change record, and the plan columns it feeds.

    ``key`` and ``name`` are columns of the change record, ``fk`` is the plan
    column holding the key, ``plan_name`` the plan column holding the name.
    ``keep`` lists further plan columns that a matched row is reported with.
    """

    entity: str
    key: str
    name: str
    attributes: tuple[tuple[str, str], ...] = ()
    fk: str = ""
    plan_name: str = ""
    plan_id: str = "PLAN_ID"
    plan_op: str = "op_type"
    keep: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "fk", self.fk or self.key)
        object.__setattr__(self, "plan_name", self.plan_name or self.name)

    @property
    def schema(self) -> T.StructType:
        """Row schema of a change record: envelope, key, name, attributes."""
        schema = T.StructType([T.StructField(c, T.StringType()) for c in ENVELOPE])
        schema.add(self.key, T.LongType(), nullable=False).add(self.name, T.StringType())
        for column, kind in self.attributes:
            schema.add(column, kind)
        return schema


def _text(*columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((c, "string") for c in columns)


def _long(*columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((c, "long") for c in columns)


# Record columns of the eight dimensions. The target group's key
# has no column of its own name in the plan, so its foreign key is set apart.
ENTITIES: dict[str, EntitySpec] = {
    spec.entity: spec
    for spec in (
        EntitySpec(
            "advertiser",
            "ADVERTISER_ID",
            "ADVERTISER_NAME",
            _text(
                "ADVERTISER_CREATION_DT",
                "ADVERTISER_MODIFICATION_DT",
                "CREATE_DATE",
                "ACCOUNTING_IDENT",
            ),
            keep=(
                "ORIGINAL_PLAN_ID",
                "PLAN_NAME",
                "PORTFOLIO_PLAN_ID",
                "PRG_PLAN_ID",
                "PROPERTY_ID",
                "REVISION_NO",
                "STEW_LINK_ID",
            ),
        ),
        EntitySpec(
            "agency",
            "AGENCY_ID",
            "AGENCY_NAME",
            _text("AGENCY_CREATION_DT", "AGENCY_MODIFICATION_DT")
            + _long("PARENT_AGENCY_ID")
            + _text("CREATE_DATE", "ACCOUNTING_IDENT"),
        ),
        EntitySpec(
            "account_executive",
            "ACCOUNT_EXECUTIVE_ID",
            "ACCOUNT_EXECUTIVE",
            _text("CREATE_DATE", "SALES_TEAM_IDS"),
        ),
        EntitySpec(
            "deal_year",
            "DEAL_YEAR_ID",
            "DEAL_YEAR_NAME",
            _text(
                "CALENDAR_START_DATE",
                "CALENDAR_END_DATE",
                "BROADCAST_START_DATE",
                "BROADCAST_END_DATE",
                "CREATE_DATE",
            ),
        ),
        EntitySpec(
            "division",
            "CHANNEL_DIVISION_ID",
            "CHANNEL_DIVISION_NAME",
            _long("PROPERTY_ID")
            + _text("PROPERTY_NAME")
            + _long("INACTIVE")
            + _text("CREATE_DATE"),
        ),
        EntitySpec(
            "sub_division",
            "CHANNEL_SUB_DIVISION_ID",
            "CHANNEL_SUB_DIVISION_NAME",
            _long("CHANNEL_DIVISION_ID")
            + _text("CHANNEL_DIVISION_NAME")
            + _long("PROPERTY_ID")
            + _text("PROPERTY_NAME")
            + _long("INACTIVE")
            + _text("CREATE_DATE"),
        ),
        EntitySpec(
            "target_group",
            "DEMO_ID",
            "DEMO_NAME",
            _long("AUDIENCE_ID")
            + _text("FORMULA")
            + _long("BLDNG_BLOCK_TYPE_CODE", "STEWARDSHIP_DEMO")
            + _text("CREATE_DATE"),
            fk="PRIMARY_DEMO_ID",
        ),
        EntitySpec(
            "property",
            "PROPERTY_ID",
            "PROPERTY_NAME",
            _text(
                "NETWORK_ID",
                "PARENT_CHANNEL_ID",
                "AUTOMATION_CODE",
                "AUTOMATION_NAME",
                "CALL_SIGN_NAME",
                "SALES_DAYPART_SET_ID",
                "CREATE_DATE",
                "RATED_NETWORK",
            ),
        ),
    )
}
