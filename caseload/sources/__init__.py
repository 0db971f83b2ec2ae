from caseload.sources.tables import read_table, TABLES  # noqa: F401
from caseload.sources.contracts import require_columns  # noqa: F401
