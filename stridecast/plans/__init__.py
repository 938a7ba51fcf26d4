"""Jobs put together from sources and operators."""
