"""Writers: upserts, overwrites, serving projections, exports."""
