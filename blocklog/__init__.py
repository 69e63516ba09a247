"""blocklog: verified copy, backup, restore, comparison and statistics of sequenced block logs."""

__version__ = "0.1.0"
