"""Analyses of the register of installations, the grid series and the weather tables."""
