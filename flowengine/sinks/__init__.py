"""Writers, storage layout and table registration."""
