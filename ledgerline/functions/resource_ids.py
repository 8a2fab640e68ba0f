"""Resource identifiers ``arn:<partition>:<service>:<region>:<account>:feature-group/<name>``."""

import re
from dataclasses import dataclass

from pyspark.sql import functions as F

from ledgerline.errors import INVALID_RESOURCE_ID, ValidationError


@dataclass(frozen=True)
class ResourceIdFormat:
    """The two segments that depend on where the groups live."""

    partition: str = "cloud"
    service: str = "features"

    @property
    def pattern(self):
        # The shape of an identifier.
        return (
            rf"arn:{re.escape(self.partition)}[a-z\-]*:{re.escape(self.service)}"
            r":[a-z0-9\-]*:[0-9]{12}:feature-group/.*"
        )

    def columns(self, c):
        """Validity and the four parts of an identifier column; null where not valid."""
        valid = F.coalesce(c.rlike(rf"\A(?:{self.pattern})\z"), F.lit(False))
        parts = F.split(c, ":")
        # The text between the first two slashes; none when only slashes follow.
        name = F.when(
            c.rlike(r"\A[^/]*/.*[^/]"), F.regexp_extract(c, r"\A[^/]*/([^/]*)", 1)
        )
        return {
            "is_valid": valid,
            "group_name": F.when(valid, name),
            "region": F.when(valid, F.get(parts, F.lit(3))),
            "account": F.when(valid, F.get(parts, F.lit(4))),
            "partition": F.when(valid, F.get(parts, F.lit(1))),
        }

    def group_name(self, resource_id):
        """Name part of one identifier; raises when the identifier is not valid."""
        if not re.fullmatch(self.pattern, resource_id):
            raise ValidationError(INVALID_RESOURCE_ID)
        rest = resource_id.partition("/")[2]
        if not rest.strip("/"):
            raise ValidationError(INVALID_RESOURCE_ID)
        return rest.partition("/")[0]


def parse_resource_ids(df, column, id_format=ResourceIdFormat()):
    """``df`` with the parsed parts of its identifier column."""
    return df.withColumns(id_format.columns(F.col(column)))
