"""Whole reports and jobs put together from operators."""
