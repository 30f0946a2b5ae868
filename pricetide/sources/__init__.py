"""Readers, landing, the warehouse tables and feeds derived from other tables."""
