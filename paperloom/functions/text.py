"""Text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameter names that carry secrets, and the replacement. The class
# adds the four separators that count as white space besides the Unicode property.
SECRET_PATTERN = r"(?iU)((?:api_key|access_token|password)=)[^\s\x1C-\x1F&]+"
REPLACEMENT = "[REDACTED]"


def redact_secrets(text, secret: str | None = None) -> Column:
    """Blank out secret parameter values, and one literal secret where given."""
    value = F.col(text) if isinstance(text, str) else text
    if secret:
        value = F.replace(value, F.lit(secret), F.lit(REPLACEMENT))
    return F.regexp_replace(value, SECRET_PATTERN, "$1" + REPLACEMENT)
