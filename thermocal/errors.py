"""One error type per failure family, so callers catch one thing."""


class MissingColumnsError(KeyError):
    """Required columns are absent; the message lists what is missing and what exists."""

    def __init__(self, missing, available, what="input"):
        self.missing = list(missing)
        self.available = list(available)
        super().__init__(
            f"{what}: missing required column(s) {self.missing}; available: {', '.join(self.available)}")


class InvalidInputError(ValueError):
    """Input values violate an operator's precondition (e.g. target <= 0 before log10)."""


class NotFittedError(RuntimeError):
    """Parameters were requested from a model that has not been fitted."""
