"""Writes.  Each warehouse sink may run again with the same input and leave the same table."""
