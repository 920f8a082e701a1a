"""Risk score and level."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import constants as C


def zone_priority_sql(zone_type: str = "zone_type") -> str:
    """Rank of a zone type, higher first; unknown types rank lowest."""
    ranks = " ".join(f"WHEN '{kind}' THEN {rank}" for kind, rank in C.ZONE_PRIORITY.items())
    return f"CASE {zone_type} {ranks} ELSE 0 END"


def risk_score(
    in_restricted: str = "in_restricted_zone",
    zone_type: str = "zone_type",
    port_nm: str = "distance_to_port",
    speed: str | None = None,
) -> Column:
    """Zone weight, plus nearness to a port, plus speed; leave out ``speed`` for cell crossings."""
    weights = C.ZONE_WEIGHTS
    score = (
        f"CASE WHEN {in_restricted} THEN {weights['RESTRICTED']}D"
        f" WHEN {zone_type} = 'PORT' THEN {weights['PORT']}D"
        f" WHEN {zone_type} = 'EEZ' THEN {weights['EEZ']}D ELSE 0D END"
        f" + CASE WHEN {port_nm} < {C.NEAR_PORT_NM}D THEN {C.NEAR_PORT_WEIGHT}D ELSE 0D END"
    )
    if speed is not None:
        score += f" + CASE WHEN {speed} > {C.HIGH_SPEED_KN}D THEN {C.HIGH_SPEED_WEIGHT}D ELSE 0D END"
    return F.expr(score)


def risk_level(score: str = "risk_score") -> Column:
    return F.expr(
        f"CASE WHEN {score} >= {C.HIGH_SCORE}D THEN 'HIGH' WHEN {score} >= {C.MEDIUM_SCORE}D THEN 'MEDIUM'"
        " ELSE 'LOW' END"
    )
