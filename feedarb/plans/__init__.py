"""Distributed building blocks, durable tables, the registered reports."""
