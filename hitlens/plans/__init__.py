from . import sql_reports

__all__ = ["sql_reports"]
