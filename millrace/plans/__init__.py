"""Jobs composed from the operators. Each module can be run with ``python -m``."""
