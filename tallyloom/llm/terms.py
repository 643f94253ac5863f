"""Terms of a text: runs of ASCII letters, digits and characters beyond ASCII."""

_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """All terms in order, in UTF-8, with A-Z lowered; none for null."""
    return (text or "").encode("utf-8").translate(_TABLE).split()
