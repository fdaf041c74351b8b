"""Checks of query arguments, made on the driver before anything is planned."""


def whole_number(name: str, value, least: int = 0) -> int:
    """``value`` as an int of at least ``least``; text such as ``"20"`` is accepted."""
    if isinstance(value, bool) or not isinstance(value, (int, str)):
        raise ValueError(f"{name} must be a whole number, got {value!r}")
    try:
        number = int(value)
    except ValueError:
        raise ValueError(f"{name} must be a whole number, got {value!r}") from None
    if number < least:
        raise ValueError(f"{name} must be at least {least}, got {number}")
    return number


def one_of(name: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, got {value!r}")
    return value
