from tripforge.cli import main

main()
