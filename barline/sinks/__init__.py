"""Writers: lake partitions, versioned warehouse tables, exports."""
