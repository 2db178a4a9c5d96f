"""Rating event messages: JSON on the wire, columns inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tasteloom.sources.schemas import MESSAGE


def encode_message() -> Column:
    """JSON text of one rating event, from columns named as in the message."""
    return F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGE]))


def decode_message(value: Column) -> Column:
    """Struct of one rating event. Text that is not such an object gives NULL fields."""
    return F.from_json(value.cast("string"), MESSAGE)


def in_replay_part(id_column: str = "Id") -> Column:
    """The 40 % of reviews replayed as events; the other 60 % are for training."""
    # Ten residue classes, the last four are replayed.
    return F.pmod(F.col(id_column), F.lit(10)) >= 6
