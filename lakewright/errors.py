"""The one exception the operators raise when they refuse to work."""


class LakeError(Exception):
    """A check failed; ``problems`` lists every finding, not just the first."""

    def __init__(self, message: str, problems: list[str] | None = None):
        self.problems = list(problems or [])
        super().__init__(message if not self.problems else f"{message}: " + "; ".join(self.problems))
