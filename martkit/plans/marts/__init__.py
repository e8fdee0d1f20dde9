"""Marts: functions from domain tables to one result frame."""
