"""Key columns every conformed frame shares."""

YEAR, PERIOD, CODE, NAME = "YEAR", "PERIOD", "CODE", "NAME"
PERIOD_KEYS = [YEAR, PERIOD]
KEYS = [YEAR, PERIOD, CODE]
