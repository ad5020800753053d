"""Nightly lodging revenue from raw reservations, as plain DataFrame functions."""
