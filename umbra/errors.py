"""Errors raised when an input or an option cannot be honoured."""


class InputError(ValueError):
    """A file or table is not what the reader was asked to read."""


class OptionError(ValueError):
    """An option has a value that no rule covers."""


class DesignError(ValueError):
    """The sample design cannot support what was asked of it."""
