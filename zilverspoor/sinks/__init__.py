"""Write modes, multi-table loads and part dumps."""
