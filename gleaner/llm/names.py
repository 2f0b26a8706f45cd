"""Column names that a table lacks."""


def free_name(name: str, taken: list[str]) -> str:
    """The name, with as many underscores as keep it apart from the names taken."""
    while name.lower() in map(str.lower, taken):
        name += "_"
    return name
