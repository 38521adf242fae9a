"""Errors a pipeline stage may raise; any of them stops the run."""


class MedallionError(Exception):
    """Base of all errors of this library."""


class EmptyInput(MedallionError):
    """A raw source holds no record."""


class EmptyResult(MedallionError):
    """The Gold result has no row; earlier output is left as it was."""


class MissingColumns(MedallionError):
    """Columns that the next step needs are absent."""

    def __init__(self, columns):
        self.columns = list(columns)
        super().__init__(f"missing columns: {', '.join(self.columns)}")


class HeaderMismatch(MedallionError):
    """CSV files of one folder have headers that differ even under canonical names."""


class LocationMismatch(MedallionError):
    """A table of that name lies at another location."""


class LostKeys(MedallionError):
    """Keys in the raw data do not fit the declared type."""


class UnknownOption(MedallionError):
    """A grouping column, metric, mode or stage outside the allowed list."""
