from salesflow.cli import main

main()
